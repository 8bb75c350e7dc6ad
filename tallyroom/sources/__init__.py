"""Readers: delimited files, Parquet folders, database tables and zip archives."""
