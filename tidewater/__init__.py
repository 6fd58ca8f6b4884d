"""tidewater: topic-log analytics on Spark DataFrames."""
