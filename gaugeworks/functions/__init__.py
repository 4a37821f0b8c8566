"""Column expressions: time handling and values."""
