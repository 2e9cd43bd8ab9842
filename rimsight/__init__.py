"""Sports and career analytics as Spark DataFrame jobs."""
