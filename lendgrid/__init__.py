"""Credit-risk analytics as Spark DataFrame jobs."""
