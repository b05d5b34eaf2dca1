"""Column expressions, aggregates and fixed lookup tables."""
