"""Relational operators of the warehouse, composed from built-in Spark operators."""
