"""Operators of a training-data pipeline: duplicates, filters, mixing, packing, encoding."""
