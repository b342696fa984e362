"""Readers and writers: delimited text, Parquet, JDBC, landing area, history."""
