"""Spark-first building blocks for a raw -> history -> facts lakehouse."""
