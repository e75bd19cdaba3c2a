"""ridelake: shared-mobility analytics as PySpark DataFrame and Structured Streaming jobs."""
