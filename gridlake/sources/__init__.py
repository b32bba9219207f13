"""Readers: case text, CSV tables and profiles, Parquet tables."""
