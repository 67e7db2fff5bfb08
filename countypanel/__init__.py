"""County-by-year policy panels on Spark DataFrames."""
