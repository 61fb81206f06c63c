"""Customer-graph analytics as Spark DataFrame jobs."""
