"""Column expressions: calendar, cleaning, measures and text."""
