"""callmill: evidence-checked outlook calls and corpus preparation on Spark DataFrames."""
