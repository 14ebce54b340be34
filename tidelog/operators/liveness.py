"""Dead and quiet streams, from the history of their frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidelog.functions.times import SECOND
from tidelog.model import NO_EVENTS_WARNING_SECS, NO_FRAMES_WARNING_SECS, STREAM_DEAD_NO_FRAMES_SECS
from tidelog.operators.segments import SEGMENT_ROWS, position_segment, segmented_scan


@dataclass(frozen=True)
class StreamDeadPolicy:
    """``never``, ``no_frames_for`` or ``no_events_for`` a number of seconds."""

    kind: str = "no_frames_for"
    seconds: int = STREAM_DEAD_NO_FRAMES_SECS

    def __post_init__(self):
        if self.kind not in ("never", "no_frames_for", "no_events_for"):
            raise ValueError(f"unknown dead policy: {self.kind}")
        if self.kind != "never" and self.seconds == 0:
            raise ValueError("seconds of a dead policy may not be 0")


def quiet_periods(
    lines: DataFrame,
    as_of: Column,
    policy: StreamDeadPolicy = StreamDeadPolicy(),
    warn_no_frames_secs: int = NO_FRAMES_WARNING_SECS,
    warn_no_events_secs: int = NO_EVENTS_WARNING_SECS,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Periods between frames and between event batches that were long enough to matter.

    ``lines`` has stream_id, frame_id, started_at and kind (``batch``/``keep_alive``).
    One row per period and what was missing (``frames`` or ``events``), with
    ``severity``: ``warning`` from the limit on (``>=``), ``dead`` beyond the policy's
    limit (``>``). The period open at ``as_of`` counts up to then.
    """
    rows = lines.select(
        "stream_id", "frame_id", (F.col("kind") == "batch").alias("_is_batch"), F.unix_micros("started_at").alias("_at")
    ).withColumn("_batch_at", F.when(F.col("_is_batch"), F.col("_at")))
    segment = position_segment("frame_id", segment_rows)
    scanned = segmented_scan(
        rows,
        ["stream_id"],
        ["frame_id"],
        segment,
        max_before={"_events_before": F.col("_batch_at")},
        lag={"_frame_before": "_at"},
    )
    closed = scanned.select(
        "stream_id",
        F.explode(
            F.array(
                F.struct(
                    F.lit("frames").alias("missing"),
                    F.col("_frame_before").alias("from_us"),
                    F.col("_at").alias("until_us"),
                    F.lit(False).alias("open"),
                ),
                F.struct(
                    F.lit("events").alias("missing"),
                    F.col("_events_before").alias("from_us"),
                    F.col("_batch_at").alias("until_us"),
                    F.lit(False).alias("open"),
                ),
            )
        ).alias("p"),
    )
    ends = scanned.groupBy("stream_id").agg(F.max("_at").alias("f"), F.max("_batch_at").alias("e"))
    now = F.unix_micros(as_of)
    tail = ends.select(
        "stream_id",
        F.explode(
            F.array(
                F.struct(
                    F.lit("frames").alias("missing"), F.col("f").alias("from_us"), now.alias("until_us"), F.lit(True).alias("open")
                ),
                F.struct(
                    F.lit("events").alias("missing"), F.col("e").alias("from_us"), now.alias("until_us"), F.lit(True).alias("open")
                ),
            )
        ).alias("p"),
    )
    quiet = F.col("until_us") - F.col("from_us")
    limit = F.when(F.col("missing") == "frames", F.lit(warn_no_frames_secs * SECOND)).otherwise(
        F.lit(warn_no_events_secs * SECOND)
    )
    watched = {"no_frames_for": "frames", "no_events_for": "events"}.get(policy.kind)
    dead = F.lit(False) if watched is None else (F.col("missing") == watched) & (quiet > policy.seconds * SECOND)
    return (
        closed.unionByName(tail)
        .select("stream_id", "p.*")
        .withColumn("quiet_us", quiet)
        .withColumn("severity", F.when(dead, F.lit("dead")).when(quiet >= limit, F.lit("warning")))
        .filter(F.col("severity").isNotNull())
    )
