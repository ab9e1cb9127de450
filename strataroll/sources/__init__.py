"""Readers for raw documents and versioned Parquet tables."""
