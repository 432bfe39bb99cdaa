"""Column expressions and column-wise cleaning."""
