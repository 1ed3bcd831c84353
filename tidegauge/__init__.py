"""tidegauge: data-quality, ingestion and drift jobs on Spark DataFrames and streams."""
