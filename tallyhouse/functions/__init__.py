"""Column -> Column helpers."""
