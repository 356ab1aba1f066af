"""Incident operators, each a DataFrame -> DataFrame function."""
