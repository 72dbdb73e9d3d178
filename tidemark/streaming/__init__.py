"""Incremental flows: new files into raw tables, new raw rows into clean tables."""
