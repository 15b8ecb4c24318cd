"""Operators of a training-data pipeline: dedup, filters, tokenisers, mixing."""
