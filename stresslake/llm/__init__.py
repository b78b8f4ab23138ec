"""Operators for training-data pipelines: mixing, filters, near-duplicates, search, tokens."""
