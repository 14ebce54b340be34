"""Structured Streaming operators: consumption, liveness, handler state."""
