"""Whole plans: inputs derived from the given tables, pipelines, and the query list."""
