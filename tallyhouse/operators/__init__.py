"""Relational building blocks that Spark does not offer as one call."""
