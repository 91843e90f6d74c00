"""Customer-segment analytics as Spark DataFrame jobs."""
