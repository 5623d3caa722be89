"""Public-spend analytics on Spark DataFrames."""
