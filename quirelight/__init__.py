"""Document-identity analytics on Spark DataFrames."""
