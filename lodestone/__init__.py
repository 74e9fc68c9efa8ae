"""Document structuring and hybrid retrieval on Spark DataFrames."""
