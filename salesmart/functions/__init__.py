"""Column-valued building blocks."""
