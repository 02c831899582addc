"""Reusable DataFrame operators that are not a single built-in."""
