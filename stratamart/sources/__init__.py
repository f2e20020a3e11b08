"""Readers, generators and the Parquet layout of stored tables."""
