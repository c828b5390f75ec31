"""Readers: CSV extracts, versioned Parquet tables, and sources derived from sample tables."""
