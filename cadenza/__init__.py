"""Music and listening-event analytics on Spark DataFrames and Structured Streaming."""
