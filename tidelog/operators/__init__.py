"""Batch operators over event logs, frames, cursors and publish responses."""
