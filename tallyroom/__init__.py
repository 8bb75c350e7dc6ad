"""Tabular ETL and summary analytics for flat entity tables, on Spark DataFrames."""
