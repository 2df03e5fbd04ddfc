"""End-to-end task jobs, the spark-submit entry point, the query catalog and its oracle SQL."""
