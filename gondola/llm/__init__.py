"""Operators for training-data pipelines: extraction, filtering, deduplication, tokens, search."""
