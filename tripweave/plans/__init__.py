"""Whole jobs: storing trips by day and week, computing metrics, reporting."""
