"""Operators for training-data pipelines: encoding, deduplication, scoring, mixing, packing."""
