"""Column expressions and Arrow/NumPy bridges for fixed-width numeric vectors."""
