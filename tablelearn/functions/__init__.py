"""Column-level building blocks: missing values, type inference, metrics, literal tables."""
