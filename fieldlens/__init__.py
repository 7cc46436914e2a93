"""Field-survey consolidation and quality checks as Spark jobs."""
