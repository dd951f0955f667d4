"""Spark-native ingestion, catalog analytics and curation."""

__version__ = "0.1.0"
