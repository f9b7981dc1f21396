"""Readers and writers: historical tables, landing JSON, silver/gold Parquet."""
