"""Traffic-anomaly analytics expressed as Spark DataFrame, SQL, MLlib and Structured Streaming jobs."""
