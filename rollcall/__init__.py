"""rollcall: legislative-data operators on Spark DataFrames."""
