"""Column expressions and small column-wise table functions."""
