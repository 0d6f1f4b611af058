"""Named queries and their DuckDB oracle SQL."""
