"""DataFrame operators: skew-safe joins, global numbering, lookups."""
