"""Operators for training-data pipelines: deduplication, decontamination, scoring, mixing, sharding."""
