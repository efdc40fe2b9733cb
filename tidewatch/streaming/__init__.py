"""Continuous ingest and the live picture as Structured Streaming jobs."""
