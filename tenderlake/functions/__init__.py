"""Functions of the tender-data library."""
