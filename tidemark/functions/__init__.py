"""Column expressions: defaults, text, dates and JSON text."""
