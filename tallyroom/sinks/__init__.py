"""Writers: Parquet folders, Spark tables and database tables."""
