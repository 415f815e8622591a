"""Column functions and row-level parsing."""
