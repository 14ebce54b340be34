"""Schemas and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Offsets.
BEGIN = -1
BEGIN_TEXT = "begin"

# Data operations of data-change events.
DATA_OPS = {"C": "create", "U": "update", "D": "delete", "S": "snapshot"}

# Publishing status.
SUBMITTED, FAILED, ABORTED = "submitted", "failed", "aborted"

# Handler outcomes.
COMMIT, DO_NOT_COMMIT, ABORT_STREAM, SHUT_DOWN = "commit", "do_not_commit", "abort_stream", "shut_down"

# Default stream parameters.
STREAM_DEFAULTS = {
    "max_uncommitted_events": 10,
    "batch_limit": 1,
    "stream_limit": 0,
    "batch_flush_timeout_secs": 30,
    "batch_timespan_secs": 0,
    "stream_timeout_secs": 0,
    "commit_timeout_secs": 60,
}

# Default limits in seconds.
PARTITION_INACTIVITY_SECS = 90
NO_FRAMES_WARNING_SECS = 30
NO_EVENTS_WARNING_SECS = 60
STREAM_DEAD_NO_FRAMES_SECS = 300

ETP = ["event_type", "partition"]


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _struct(columns: str) -> T.StructType:
    # Not StructType.fromDDL: that needs a running session at import time.
    fields = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


LOG = _struct(
    "event_type string, partition string, offset bigint, eid string, occurred_at timestamp,"
    " received_at timestamp, key string, payload string"
)
CURSOR = _struct("event_type string, partition string, offset string, cursor_token string")
METADATA = _struct(
    "eid string, event_type string, occurred_at timestamp, received_at timestamp,"
    " parent_eids array<string>, partition string, version string, flow_id string"
)
FRAMES = _struct(
    "stream_id string, frame_id bigint, value string, started_at timestamp, completed_at timestamp"
)


def business_event(payload: T.StructType) -> T.StructType:
    """Payload fields at the top level, plus ``metadata``."""
    return T.StructType([*payload.fields, T.StructField("metadata", METADATA)])


def data_change_event(payload: T.StructType) -> T.StructType:
    """``data``, ``data_type`` and ``data_op``, plus ``metadata``."""
    return T.StructType(
        [
            T.StructField("data", payload),
            T.StructField("data_type", T.StringType()),
            T.StructField("data_op", T.StringType()),
            T.StructField("metadata", METADATA),
        ]
    )
