"""Readers and writers: raw text, CSV, Parquet, collections, driver tables."""
