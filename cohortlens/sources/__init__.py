"""Sources (parquet tables, logical-input adapters) and sinks."""
