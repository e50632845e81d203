"""Joins, windows, checks and table changes that need more than one built-in call."""
