"""Streaming of the tender-data library."""
