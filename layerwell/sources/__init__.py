"""Reading files and tables."""
