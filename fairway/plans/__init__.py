"""Plans: report queries, the end-to-end metrics job, and the registry of
driver queries with their DuckDB oracles."""
