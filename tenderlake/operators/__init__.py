"""Operators of the tender-data library."""
