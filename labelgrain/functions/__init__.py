"""Column expressions: text, labels and numbers."""
