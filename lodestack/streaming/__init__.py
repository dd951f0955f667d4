"""Structured Streaming forms of the catalog jobs."""
