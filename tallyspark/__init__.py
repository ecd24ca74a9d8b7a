"""Finance analytics as Spark DataFrame jobs."""
