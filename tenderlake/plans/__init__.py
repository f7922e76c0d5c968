"""Plans of the tender-data library."""
