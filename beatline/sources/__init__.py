"""Readers of tables, files, messages, boundaries, changes and model runs."""
