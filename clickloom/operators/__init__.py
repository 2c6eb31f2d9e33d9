"""Reusable DataFrame operators whose physical plan needs some care."""
