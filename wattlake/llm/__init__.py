"""Operators of a training-data pipeline: filtering, deduplication, mixing, packing, archives and search."""
