"""Streaming ingestion and the incremental merge."""
