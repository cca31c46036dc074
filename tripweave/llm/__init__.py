"""Operators of a training-data pipeline: extraction, deduplication, filters, tokens, archives."""
