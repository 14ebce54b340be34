"""Rules along the order of a partition or a stream: gaps, totals, activity, batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tidelog.functions.times import SECOND
from tidelog.model import ETP, NO_FRAMES_WARNING_SECS, PARTITION_INACTIVITY_SECS
from tidelog.operators.joins import join_null_safe, join_small
from tidelog.operators.offsets import number_rows
from tidelog.operators.segments import CUT_ROWS, FRAME_ROWS, SEGMENT_ROWS, chained_cuts, position_segment, segmented_scan


def frame_gaps(
    frames: DataFrame,
    warn_secs: int = NO_FRAMES_WARNING_SECS,
    segment_rows: int = FRAME_ROWS,
) -> DataFrame:
    """Time since the previous frame of the stream, flagged from ``warn_secs`` on.

    On batches only (keep-alives dropped before) this is the batch gap; the first
    frame has none.
    """
    rows = frames.withColumn("_at", F.unix_micros("started_at"))
    scanned = segmented_scan(
        rows, ["stream_id"], ["frame_id"], position_segment("frame_id", segment_rows), lag={"_before": "_at"}
    )
    return (
        scanned.withColumn("gap_us", F.col("_at") - F.col("_before"))
        .withColumn("warning", F.coalesce(F.col("gap_us") >= warn_secs * SECOND, F.lit(False)))
        .drop("_at", "_before")
    )


def frame_order(
    frames: DataFrame, keys: Sequence[str], segment_rows: int = FRAME_ROWS
) -> DataFrame:
    """Frames per assignment in order of arrival that do not have a higher id than before.

    ``frames`` has ``arrival`` (an increasing number per stream) and ``frame_id``.
    """
    scanned = segmented_scan(
        frames,
        keys,
        ["arrival"],
        position_segment("arrival", segment_rows),
        lag={"previous_frame_id": "frame_id"},
    )
    return scanned.withColumn(
        "increasing",
        F.coalesce(F.col("frame_id") > F.col("previous_frame_id"), F.lit(True)),
    )


def in_flight(deltas: DataFrame, segments: int | None = None) -> DataFrame:
    """Running totals per stream from signed changes.

    ``deltas`` has stream_id, at (TIMESTAMP), seq (breaking ties) and signed
    ``batches_in_flight``, ``events_in_flight``, ``bytes_in_flight``,
    ``uncommitted_batches`` and ``uncommitted_events``.
    """
    totals = ("batches_in_flight", "events_in_flight", "bytes_in_flight", "uncommitted_batches", "uncommitted_events")
    order = ["at", "seq"]
    renamed = deltas.select("stream_id", *order, *[F.col(c).cast("long").alias(f"d_{c}") for c in totals])
    return segmented_scan(
        renamed,
        ["stream_id"],
        order,
        segments,
        running_sum={c: F.col(f"d_{c}") for c in totals},
    ).select("stream_id", *order, *totals)


def left_over(deltas: DataFrame) -> DataFrame:
    """Totals at stream end and whether any of them is not 0."""
    totals = ("batches_in_flight", "events_in_flight", "bytes_in_flight", "uncommitted_batches", "uncommitted_events")
    ends = deltas.groupBy("stream_id").agg(*[F.sum(c).cast("long").alias(c) for c in totals])
    warning = F.lit(False)
    for c in totals:
        warning = warning | (F.col(c) != 0)
    return ends.withColumn("warning", warning)


def activity_intervals(
    rows: DataFrame,
    timeout_secs: int = PARTITION_INACTIVITY_SECS,
    stream_end: Column | None = None,
    *,
    keys: Sequence[str] = ETP,
    at: str = "received_at",
    position: str = "offset",
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Active intervals per partition.

    A partition is active from its first event and becomes inactive once more than
    ``timeout_secs`` passed since its last one. The interval open at ``stream_end`` and
    not yet timed out lasts until then; closed ones last until their last event.

    Each segment of a partition finds its own intervals in one shuffle; only the first
    one of a segment can continue the last one of the segment before, which the
    segments' ends decide.
    """
    timeout = timeout_secs * SECOND
    group = [*keys, "_segment"]
    segment = position_segment(position, segment_rows)
    timed = rows.select(*keys, position, F.unix_micros(at).alias("_at"), segment.alias("_segment")).repartition(*group)
    local = Window.partitionBy(*group).orderBy(position)
    gap = F.col("_at") - F.col("_before")
    opens = (F.col("_before").isNull() | (gap > timeout)).cast("long")
    parts = (
        timed.withColumn("_before", F.lag("_at").over(local))
        .withColumn("_no", F.sum(opens).over(local))
        .groupBy(*group, "_no")
        .agg(F.min("_at").alias("from_us"), F.max("_at").alias("last_us"), F.count(F.lit(1)).alias("n_events"))
    )
    along = Window.partitionBy(*keys).orderBy("_segment")
    # The last interval ends with the segment's last event, which need not be its latest.
    ends = (
        parts.groupBy(*group)
        .agg(F.min_by("from_us", "_no").alias("_from"), F.max_by("last_us", "_no").alias("_last"), F.max("_no").alias("_n"))
        .withColumn("_joins", F.coalesce(F.col("_from") - F.lag("_last").over(along) <= timeout, F.lit(False)).cast("long"))
        .withColumn("_n_before", F.sum(F.col("_n") - F.col("_joins")).over(along.rowsBetween(Window.unboundedPreceding, -1)))
        .select(*group, (F.coalesce("_n_before", F.lit(0)) - F.col("_joins")).alias("_shift"))
    )
    intervals = (
        join_null_safe(parts, ends, group)
        .groupBy(*keys, (F.col("_shift") + F.col("_no")).alias("interval_no"))
        .agg(F.min("from_us").alias("from_us"), F.max("last_us").alias("last_us"), F.sum("n_events").alias("n_events"))
    )
    if stream_end is None:
        return intervals.withColumn("active_us", F.col("last_us") - F.col("from_us"))
    end = F.unix_micros(stream_end)
    # An interval before the last one cannot reach the end: a later event timed it out.
    still_open = F.col("last_us") + timeout >= end
    return intervals.withColumn(
        "active_us", F.when(still_open, F.greatest(end, F.col("last_us"))).otherwise(F.col("last_us")) - F.col("from_us")
    )


def batches_by_count(
    log: DataFrame,
    batch_limit: int,
    *,
    dense: bool = True,
    segment_rows: int = SEGMENT_ROWS,
    n_rows: int | None = None,
) -> DataFrame:
    """Add ``batch_no``: at most ``batch_limit`` events per batch of a partition.

    With gapless offsets the batch follows from the offset and nothing is shuffled
    but the partition's oldest offset.
    """
    if batch_limit < 1:
        raise ValueError("batch_limit must be at least 1")
    if dense:
        oldest = log.groupBy(*ETP).agg(F.min("offset").alias("_oldest"))
        place = join_small(log, oldest, ETP, n_rows=n_rows).withColumn("_place", F.col("offset") - F.col("_oldest"))
    else:
        place = segmented_scan(
            log, ETP, ["offset"], position_segment("offset", segment_rows), row_number="_rn"
        ).withColumn("_place", F.col("_rn") - 1)
    return place.select(*log.columns, F.floor(F.col("_place") / batch_limit).cast("long").alias("batch_no"))


def batches_by_timespan(
    log: DataFrame,
    span_secs: int,
    *,
    segment_rows: int = CUT_ROWS,
) -> DataFrame:
    """Add ``batch_no``: a batch ends before the event that is more than ``span_secs``
    after the batch's first one.

    An event that starts a batch is later than all before it, so an event received out of order starts none.
    """
    rows = log.select(*ETP, "offset", F.unix_micros("received_at").alias("received_us"))
    rows = rows.withColumns({"_level": F.col("received_us"), "_until": F.col("received_us") + (span_secs * SECOND + 1)})
    cut = chained_cuts(rows, ETP, "offset", "_level", "_until", segment_rows=segment_rows)
    return cut.select(*ETP, "offset", "received_us", F.col("piece").alias("batch_no"))


def order_inversions(
    log: DataFrame,
    order_keys: Sequence[str],
    *,
    segment_rows: int = SEGMENT_ROWS,
    segments: int | None = None,
) -> DataFrame:
    """Place of each event by publish order and by the ordering keys of its event type.

    ``inverted`` tells that within its partition the event comes after one with higher
    ordering keys. Information only; nothing is reordered.
    """
    order = [*order_keys, "partition", "offset"]
    placed = number_rows(log, ["event_type"], order, "key_place", segments=segments)
    scanned = segmented_scan(
        placed, ETP, ["offset"], position_segment("offset", segment_rows), running_max={"_max": F.col("key_place")}
    )
    return scanned.withColumn("inverted", F.col("key_place") < F.col("_max")).drop("_max")
