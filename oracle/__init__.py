"""Independent SQL answers to the registered queries, for DuckDB."""
