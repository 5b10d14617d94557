"""Data-quality, text-feature and retrieval operators on Spark DataFrames."""
