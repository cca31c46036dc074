"""Trip-record analytics as Spark plans.

Sub-packages: ``functions`` (column expressions), ``sources`` (readers and source
normalization), ``operators`` (DataFrame-to-DataFrame building blocks and sinks),
``plans`` (whole jobs) and ``streaming``.
"""
