"""Readers and writers: batch-line files, event logs, registries, publish sink."""
