"""Monthly retail sell-out processing on Spark DataFrames."""
