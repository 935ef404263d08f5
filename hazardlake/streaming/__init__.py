"""Streaming jobs: publish changes, land bronze, upsert silver."""
