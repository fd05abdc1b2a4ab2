"""Recommendation analytics over user-item rating tables, on Spark DataFrames."""
