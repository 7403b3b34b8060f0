"""ANSI SQL for the same answers, run by DuckDB on the same tables."""
