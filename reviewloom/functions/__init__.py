"""Column-level helpers."""
