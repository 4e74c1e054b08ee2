"""Public-budget analytics as Spark DataFrame jobs."""
