"""Column expressions: pure Column -> Column helpers."""
