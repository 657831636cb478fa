"""CSV readers and Parquet tables."""
