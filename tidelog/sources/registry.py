"""Registries: event types and subscriptions as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidelog.operators.ranks import rows_after


def event_types(table: DataFrame, name: str | None = None) -> DataFrame:
    """All event types, or the one of that name."""
    return table if name is None else table.filter(F.col("name") == name)


def subscriptions(
    table: DataFrame,
    event_type: str | None = None,
    owning_application: str | None = None,
    offset: int = 0,
) -> DataFrame:
    """Subscriptions, newest first, filtered by event type and owner, from an offset on.

    All of them: a page size only matters to a paged API. What an offset leaves out is
    found by rank, so no task holds the rows before it.
    """
    if event_type is not None:
        table = table.filter(F.array_contains("event_types", event_type))
    if owning_application is not None:
        table = table.filter(F.col("owning_application") == owning_application)
    if offset:
        table = rows_after(table, -F.unix_micros("created_at"), ["id"], offset)
    return table.orderBy(F.col("created_at").desc(), "id")
