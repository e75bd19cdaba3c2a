"""The expected results as SQL over the raw test tables, for DuckDB."""
