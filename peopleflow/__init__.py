"""People and message-stream analytics on Spark DataFrames."""
