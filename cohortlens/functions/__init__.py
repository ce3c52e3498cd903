"""Column-level helper expressions (all built-in Spark functions, no UDFs)."""
