"""Operators for training-data pipelines: deduplication, labelling, mixing, formatting, tokens and packing."""
