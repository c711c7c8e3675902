"""Operators on event tables and on rows of pull requests."""
