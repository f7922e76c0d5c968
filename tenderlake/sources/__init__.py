"""Sources of the tender-data library."""
