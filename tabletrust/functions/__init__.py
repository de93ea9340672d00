"""Column-level functions (approximate equality, text, flags, JSON)."""
