"""Data work around text classification and keyword extraction, on Spark DataFrames."""
