"""Column expressions used by the load operators."""
