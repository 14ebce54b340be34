"""Offsets: numbering, partition info, lag, distance, consumption statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tidelog.functions.times import SECOND
from tidelog.model import BEGIN, ETP
from tidelog.operators.joins import join_null_safe, join_small
from tidelog.operators.ranks import first_rows
from tidelog.operators.segments import SEGMENT_ROWS, position_segment, segmented_scan


def number_rows(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str, *, segments: int | None = None
) -> DataFrame:
    """Number the rows of each key from 0 in a total order."""
    numbered = segmented_scan(df, keys, order_by, segments, row_number="_rn")
    return numbered.select(*df.columns, (F.col("_rn") - 1).alias(name))


def append_offsets(events: DataFrame, order_by: Sequence[str], *, segments: int | None = None) -> DataFrame:
    """Give events their offsets: 0, 1, 2, … per (event_type, partition) in order."""
    return number_rows(events, ETP, order_by, "offset", segments=segments)


def partition_info(log: DataFrame) -> DataFrame:
    """Oldest and newest available offset per partition."""
    return log.groupBy(*ETP).agg(F.min("offset").alias("oldest"), F.max("offset").alias("newest"))


def latest_commits(commits: DataFrame, subscription: bool = False) -> DataFrame:
    """The highest committed offset per partition (and subscription)."""
    keys = ["subscription_id", *ETP] if subscription else ETP
    return commits.groupBy(*keys).agg(F.max("offset").alias("committed"))


def partition_stats(log: DataFrame, committed: DataFrame) -> DataFrame:
    """Per partition: newest, committed and unconsumed.

    ``unconsumed`` stays NULL where nothing was committed: unknown is not zero.
    ``committed`` has one row per partition. Events that retention removed can't be
    consumed any more, so a commit before the oldest event counts from that event.
    """
    from_here = F.greatest("committed", F.col("oldest") - 1)
    return partition_info(log).join(committed, ETP, "left").withColumn(
        "unconsumed", F.when(F.col("committed").isNotNull(), F.greatest(F.col("newest") - from_here, F.lit(0)))
    )


def unconsumed(stats: DataFrame, by: Sequence[str] = ("event_type",)) -> DataFrame:
    """Sum of unconsumed events; partitions without a figure are left out, and the sum
    is NULL when no partition has one. ``all_consumed`` is false then."""
    total = F.sum("unconsumed")
    return stats.groupBy(*by).agg(
        total.alias("unconsumed"), F.coalesce(total == 0, F.lit(False)).alias("all_consumed")
    )


def unconsumed_of_stream(stats: DataFrame, stream_id: str | Column, by: Sequence[str] = ("event_type",)) -> DataFrame:
    """As :func:`unconsumed`, counting only partitions that ``stream_id`` reads."""
    own = F.when(F.col("stream_id") == stream_id, F.col("unconsumed"))
    return stats.groupBy(*by).agg(F.sum(own).alias("unconsumed"))


def stats_report(stats: DataFrame, by: Sequence[str] = ("event_type",)) -> DataFrame:
    """The figures a metrics back end gets: here, missing is reported as 0."""
    return stats.groupBy(*by).agg(F.coalesce(F.sum("unconsumed"), F.lit(0)).alias("unconsumed"))


def cursor_lag(
    log: DataFrame,
    cursors: DataFrame,
    *,
    dense: bool = True,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Events after each cursor (columns event_type, partition, offset).

    ``dense`` logs need only the oldest and newest offset; after compaction the remaining
    events are counted. Both give the same on a dense log: events that are still there
    and come after the cursor. In a partition without events nothing is known: NULL.
    """
    cursors = cursors.select(*ETP, F.col("offset").alias("cursor_offset"))
    if dense:
        return cursors.join(partition_info(log), ETP, "left").select(
            *ETP,
            "cursor_offset",
            "newest",
            F.when(
                F.col("newest").isNotNull(),
                F.greatest(F.col("newest") - F.greatest("cursor_offset", F.col("oldest") - 1), F.lit(0)),
            ).alias("lag"),
        )
    # Cursors are put among the events and counted along, so many cursors on one
    # partition do not multiply its events.
    marks = log.select(*ETP, F.col("offset").alias("_pos"), F.lit(0).alias("_mark")).unionByName(
        cursors.distinct().select(*ETP, F.col("cursor_offset").alias("_pos"), F.lit(1).alias("_mark"))
    )
    counted = segmented_scan(
        marks,
        ETP,
        ["_pos", "_mark"],
        position_segment("_pos", segment_rows),
        running_sum={"_upto": (1 - F.col("_mark")).cast("long")},
    )
    totals = log.groupBy(*ETP).agg(F.max("offset").alias("newest"), F.count(F.lit(1)).alias("_n"))
    return (
        counted.filter(F.col("_mark") == 1)
        .join(totals, ETP, "left")
        .select(*ETP, F.col("_pos").alias("cursor_offset"), "newest", (F.col("_n") - F.col("_upto")).alias("lag"))
    )


def cursor_distance(pairs: DataFrame) -> DataFrame:
    """Events between two cursors, the first one exclusive.

    ``pairs`` has initial_/final_ event_type, partition and offset. Pairs over two
    partitions, or running backwards, carry an error and no distance.
    """
    same = (F.col("initial_event_type") == F.col("final_event_type")) & (
        F.col("initial_partition") == F.col("final_partition")
    )
    difference = F.col("final_offset") - F.col("initial_offset")
    error = F.when(~F.coalesce(same, F.lit(False)), F.lit("different partitions")).when(
        difference < 0, F.lit("final cursor is before initial cursor")
    )
    return pairs.withColumn("error", error).withColumn("distance", F.when(F.col("error").isNull(), difference))


def time_lag(log: DataFrame, committed: DataFrame, as_of: Column, n_rows: int | None = None) -> DataFrame:
    """Age in seconds of the oldest unconsumed event per partition, NULL if none is pending.

    A partition without a commit counts from its first event. ``n_rows`` is an upper
    bound of the rows of ``committed``.
    """
    pending = F.when(F.col("offset") > F.coalesce("committed", F.lit(BEGIN)), F.col("received_at"))
    rows = join_small(log.select(*ETP, "offset", "received_at"), committed.select(*ETP, "committed"), ETP, "left", n_rows)
    oldest = rows.groupBy(*ETP).agg(F.min(pending).alias("oldest_pending_at"))
    age = F.floor((F.unix_micros(as_of) - F.unix_micros("oldest_pending_at")) / SECOND)
    return oldest.withColumn("lag_seconds", age.cast("long"))


def in_partitions(df: DataFrame, partitions: DataFrame | None, n_rows: int | None = None) -> DataFrame:
    """Keep the listed (event_type, partition) pairs; None means all of them."""
    if partitions is None:
        return df
    return join_small(df, partitions.select(*ETP), ETP, "left_semi", n_rows)


def read_from(
    log: DataFrame, start: str, initial_cursors: DataFrame | None = None, n_rows: int | None = None
) -> DataFrame:
    """Events after the start position.

    ``begin``: everything; ``end``: nothing that is there already; ``cursors``: what
    comes after the initial cursors, and everything in partitions without one.
    """
    if start == "begin":
        return log
    if start == "end":
        after = partition_info(log).select(*ETP, F.col("newest").alias("_start"))
    elif start == "cursors":
        if initial_cursors is None:
            raise ValueError("start 'cursors' needs initial cursors")
        after = initial_cursors.select(*ETP, F.col("offset").alias("_start"))
    else:
        raise ValueError(f"unknown start position: {start}")
    return (
        join_small(log, after, ETP, "left", n_rows)
        .filter(F.col("offset") > F.coalesce("_start", F.lit(BEGIN)))
        .select(*log.columns)
    )


def retained(log: DataFrame, retention_ms: int, as_of: Column) -> DataFrame:
    """Drop events older than the retention time."""
    return log.filter(F.unix_micros("received_at") >= F.unix_micros(as_of) - retention_ms * 1000)


def compacted(
    log: DataFrame, key: str = "key", *, base: DataFrame | None = None, leave: Column | None = None
) -> DataFrame:
    """Keep the newest event of each key within its partition.

    Events without a key stay, and so do those for which ``leave`` is true (of event types that aren't compacted,
    or too recent for it), which replace nothing either. ``base`` is an already compacted part before the log's
    events: of it goes what a key of the log replaces, without grouping it again.

    The newest offset per key is a fixed-width aggregate, reduced before the shuffle; rows are kept by
    (partition, key, offset), so the copies of a hot key don't meet in one task.
    """
    open_ = F.col(key).isNotNull()
    if leave is not None:
        open_ = open_ & ~F.coalesce(leave, F.lit(False))
    newest = log.filter(open_).groupBy(*ETP, key).agg(F.max("offset").alias("offset"))
    kept = join_null_safe(log.filter(open_), newest, [*ETP, key, "offset"], "left_semi").unionByName(log.filter(~open_))
    if base is None:
        return kept
    return join_null_safe(base, newest, [*ETP, key], "left_anti").unionByName(kept)


def first_reception(log: DataFrame, order_by: Sequence[str] = ("received_at", "event_type", "partition", "offset")) -> DataFrame:
    """Keep one event per eid, the first received; copies go before the shuffle, where they lie."""
    place = F.row_number().over(Window.partitionBy("eid").orderBy(*order_by))
    return log.withColumn("_place", place).filter("_place = 1").drop("_place")


def stream_limit(log: DataFrame, n: int) -> DataFrame:
    """At most ``n`` events over all partitions in order of reception; 0 means no limit."""
    if n == 0:
        return log
    return first_rows(log, F.unix_micros("received_at"), [*ETP, "offset"], n)
