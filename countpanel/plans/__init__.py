"""Registered queries (Spark builders + DuckDB oracle text)."""
