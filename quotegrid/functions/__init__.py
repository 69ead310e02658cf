"""Column functions: rule compiler and scalar helpers."""
