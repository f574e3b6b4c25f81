"""Plans: fixture roles, the query catalogue and its DuckDB oracle SQL."""
