"""Relational jobs over catalogs of files and datasets."""
