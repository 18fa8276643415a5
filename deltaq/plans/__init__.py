"""Query plans: the flagship query, shared steps, registered queries and DuckDB oracles."""
