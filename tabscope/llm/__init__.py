"""Operators for training-data pipelines: scoring, counting, extraction, deduplication, search and packing of texts."""
