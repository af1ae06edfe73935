"""Set-based supplier catalogue processing on Spark DataFrames."""
