"""Composed plans: derived tables, registered queries and their SQL twins."""
