"""Readers: CSV with explicit schemas, and adapters over the parquet tables."""
