"""Operators for training-data pipelines: text archives, scoring, filters, deduplication, tokens."""
