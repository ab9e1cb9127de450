"""Column and column-name helpers."""
