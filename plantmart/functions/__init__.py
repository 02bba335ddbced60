"""Column expressions: path and name rules, casts of raw text."""
