"""Play-log analytics as Spark DataFrame jobs."""
