"""Readers: the review TSV format and the provided Parquet tables."""
