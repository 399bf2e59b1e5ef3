"""Point-in-time panel and time-series analytics on Spark DataFrames."""
