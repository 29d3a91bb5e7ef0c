"""Operators of training-data pipelines: mixing, identification, deduplication, search, packing."""
