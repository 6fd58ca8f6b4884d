"""Options, the Parquet topic log and its data source."""
