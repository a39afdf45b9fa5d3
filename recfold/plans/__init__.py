"""Query plans: the fixture views over the driver tables and the registered
queries (Spark callables plus the DuckDB oracle text for each)."""
