"""Column expressions: numbers, strings and text."""
