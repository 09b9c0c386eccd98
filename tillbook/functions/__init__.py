"""Column expressions for money, text and similarity."""
