"""Readers, source normalization and the trip views over the test tables."""
