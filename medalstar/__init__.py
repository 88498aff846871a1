"""Medallion star-schema analytics for competitive-match data, on PySpark DataFrames."""
