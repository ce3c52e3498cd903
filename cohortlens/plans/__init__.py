"""Query registry (Spark plans) and the independent DuckDB oracle SQL."""
