"""Mail-graph analytics as Spark DataFrame jobs."""
