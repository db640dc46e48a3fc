"""Column expressions: blanks, hashes, JSON, geometry text."""
