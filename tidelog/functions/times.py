"""Time in whole microseconds."""

SECOND = 1_000_000
