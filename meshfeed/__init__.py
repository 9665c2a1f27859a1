"""Device and network quality feeds as Spark DataFrame and Structured Streaming jobs."""
