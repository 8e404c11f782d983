"""Operators on corpora of text; nothing else in the library imports this package."""
