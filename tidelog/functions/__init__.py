"""Column-level functions: hashing, cursors, event metadata."""
