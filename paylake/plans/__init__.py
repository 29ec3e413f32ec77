"""Plans: the query catalogue (Spark side) and the DuckDB oracle texts."""
