"""Column-expression builders (no I/O, no actions)."""
