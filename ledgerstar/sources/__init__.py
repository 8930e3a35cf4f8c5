"""Readers and writers: CSV, Parquet, views and catalog tables."""
