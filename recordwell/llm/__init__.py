"""Operators of a training-data pipeline: sharding, cleaning, duplicates, scoring, tokens."""
