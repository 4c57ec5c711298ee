"""Operators for training-data pipelines: dedup, filtering, mixing, sharding and packing of documents."""
