"""Relational building blocks that the plans are composed of."""
