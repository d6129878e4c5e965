"""Operators of a training-data pipeline: dedup, filtering, scanning, mixing, sharding, archives."""
