"""Registered queries over the given tables, and their SQL equivalents."""
