"""Operators of a training-data pipeline: joins, quality rules, formatting, dedup, scoring, packing, search, sharding."""
