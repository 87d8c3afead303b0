"""Driver-fixture adapters, query catalog and DuckDB oracle SQL."""
