"""Operators for preparing training text, and their queries. Nothing else in the library imports this package."""
