"""Column functions: casts, text, time."""
