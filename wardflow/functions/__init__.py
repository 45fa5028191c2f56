"""Column expressions: scoring, text, vectors, identifiers and time."""
