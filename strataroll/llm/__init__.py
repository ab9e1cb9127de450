"""Operators that prepare training data, each with a registered query."""
