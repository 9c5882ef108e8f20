"""DuckDB statements that compute the same results from the raw tables."""
