"""Column expressions and small scalar functions."""
