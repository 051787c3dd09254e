"""Match-statistics analytics as Spark jobs."""
