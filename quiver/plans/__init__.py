"""Registered queries (Spark builders + DuckDB oracle twins) and end-to-end jobs."""
