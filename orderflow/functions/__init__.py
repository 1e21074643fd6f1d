"""Column expressions: casts of file text, and reproducible draws."""
