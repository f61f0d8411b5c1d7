"""Column expressions: text, numbers and calendar."""
