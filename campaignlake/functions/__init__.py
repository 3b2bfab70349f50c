"""Column-level expressions."""
