"""Road-collision analytics on Spark DataFrames."""
