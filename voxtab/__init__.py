"""Object-feature analytics over Spark DataFrames."""
