"""Composed plans: derived views over the driver tables and the registered
query catalogue (Spark plans plus their DuckDB oracle SQL)."""
