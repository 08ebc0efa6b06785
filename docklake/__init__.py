"""Station telemetry analytics on Spark DataFrames."""
