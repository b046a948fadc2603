"""Queries over the given tables and, for each, the same result in plain SQL."""
