"""Reusable checks and repairs. Each takes tables and returns a table; nothing is printed."""
