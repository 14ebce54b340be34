"""Cursor and offset expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidelog.model import BEGIN, BEGIN_TEXT


def offset_value(offset: Column) -> Column:
    """Textual offset → BIGINT; ``begin`` sorts before every event (-1)."""
    return F.when(offset == BEGIN_TEXT, F.lit(BEGIN).cast("long")).otherwise(offset.try_cast("long"))


def offset_text(offset: Column) -> Column:
    """BIGINT offset → text, with ``begin`` for -1."""
    return F.when(offset == BEGIN, F.lit(BEGIN_TEXT)).otherwise(offset.cast("string"))


def empty_as_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def cursor(event_type: Column, partition: Column, offset: Column, token: Column | None = None) -> Column:
    fields = [event_type.alias("event_type"), partition.alias("partition"), offset.alias("offset")]
    return F.struct(*fields, *([token.alias("cursor_token")] if token is not None else []))


def to_partition(cur: Column) -> Column:
    """The (event_type, partition) pair of a cursor."""
    return F.struct(cur["event_type"].alias("event_type"), cur["partition"].alias("partition"))


def without_token(cur: Column) -> Column:
    return cursor(cur["event_type"], cur["partition"], cur["offset"])


def to_begin(cur: Column) -> Column:
    """The cursor that replays its partition from the first event."""
    return cursor(cur["event_type"], cur["partition"], F.lit(BEGIN_TEXT))


def read_cursor(json: Column) -> Column:
    """Read a cursor given flat, or nested as ``{"event_type": …, "cursor": {…}}``."""
    parsed = F.from_json(
        json,
        "event_type string, partition string, offset string,"
        " cursor struct<event_type: string, partition: string, offset: string>",
    )
    return F.struct(
        F.coalesce(parsed["event_type"], parsed["cursor"]["event_type"]).alias("event_type"),
        F.coalesce(parsed["partition"], parsed["cursor"]["partition"]).alias("partition"),
        F.coalesce(parsed["offset"], parsed["cursor"]["offset"]).alias("offset"),
    )
