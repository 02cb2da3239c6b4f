"""Column expressions and session helpers."""
