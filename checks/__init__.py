"""Query registry, derived inputs and DuckDB oracles for the driver's check."""
