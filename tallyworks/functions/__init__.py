"""Column expressions: text, numbers, dates and scoring rules."""
