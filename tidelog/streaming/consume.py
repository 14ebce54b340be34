"""Consuming a stream of batch lines or events with Structured Streaming.

Delivery is at least once, in publish order within a partition, and no row is dropped
for being late: there is no watermark unless a function here says so.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidelog.operators.commits import coalesce_cursors
from tidelog.operators.envelope import parse_lines, quarantined_lines, valid_lines
from tidelog.operators.handlers import (
    DEFAULT_DISPATCH,
    DISPATCH_SCOPES,
    HELD_BACK,
    Handler,
    cursors_to_commit,
    dispatch,
    raise_if_stopped,
    settle,
)
from tidelog.operators.offsets import stats_report
from tidelog.operators.segments import segmented_scan
from tidelog.streaming import ledger


class Progress:
    """How many events a consumer has handed to its handlers, known without reading anything again."""

    def __init__(self):
        self.events = None

    def count(self) -> int:
        return self.events or 0


def _admitted(lines: DataFrame, left: int) -> tuple[DataFrame, DataFrame]:
    """The lines that hold the first ``left`` events in order of their time, and the line that is cut by it.

    Of the line in which the limit is reached only the events before it are left.
    """
    order = ["started_at", "stream_id", "frame_id"]
    rows = segmented_scan(lines, [], order, running_sum={"_upto": F.col("n_events").cast("long")})
    rows = rows.withColumn("_room", F.lit(left) - (F.col("_upto") - F.col("n_events"))).filter("_room > 0")
    cut = rows.filter("_room < n_events").select("stream_id", "frame_id", F.lit(True).alias("_cut"))
    few = F.when(F.col("events").isNotNull(), F.slice("events", 1, F.least("_room", "n_events").cast("int")))
    return rows.withColumns({"events": few, "n_events": F.coalesce(F.array_size(few), F.lit(0))}).select(*lines.columns), cut


def consume(
    frames: DataFrame,
    handler: Handler | Mapping[str, Handler],
    out: str,
    mode: str = DEFAULT_DISPATCH,
    *,
    ordered: bool = True,
    trigger: dict | None = None,
    stream_limit: int = 0,
    progress: Progress | None = None,
    on_stop: str = "raise",
) -> StreamingQuery:
    """Run a handler over a stream of frames and record results and commits.

    ``frames`` is a stream with stream_id, frame_id, value, started_at, completed_at.
    Each micro-batch is read and parsed once, into ``lines``, and writes ``results`` and
    ``bad_lines`` below ``out``, in a folder of its own that a repetition replaces, and the last
    cursor per partition to the ledger (:mod:`tidelog.streaming.ledger`).

    With ``stream_limit`` exactly so many events are handed over; the line in which the limit
    is reached loses the events behind it and isn't committed. The events of a micro-batch are counted
    while its lines are written, into ``progress``, which :func:`run_with_limits` asks.

    ``on_stop``: after a handler aborted or shut down, ``raise`` ends the query; with ``hold`` only the
    scope is stopped, for all later micro-batches and restarts, and the others go on.
    """
    if on_stop not in ("raise", "hold"):
        raise ValueError(f"unknown on_stop: {on_stop}")
    progress = progress or Progress()
    scope = ["stream_id", *DISPATCH_SCOPES[mode]]

    def before(spark: SparkSession, kind: str, batch_id: int) -> DataFrame | None:
        """What the micro-batches before wrote, if anything."""
        try:
            rows = spark.read.option("basePath", f"{out}/{kind}").parquet(f"{out}/{kind}/batch=*")
        except AnalysisException:
            return None
        return rows.filter(F.col("batch") < batch_id)

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if progress.events is None:
            seen = before(spark, "results", batch_id)
            progress.events = _handed_over(seen) if seen is not None else 0
        counted = Observation()
        good_events = F.sum(F.when(F.col("problem").isNull(), F.col("n_events")).otherwise(0))
        parsed = parse_lines(batch).observe(counted, F.coalesce(good_events, F.lit(0)).alias("n"))
        parsed.write.mode("overwrite").parquet(f"{out}/lines/batch={batch_id}")
        n = counted.get["n"]
        parsed = spark.read.parquet(f"{out}/lines/batch={batch_id}")
        quarantined_lines(parsed).write.mode("overwrite").parquet(f"{out}/bad_lines/batch={batch_id}")
        good, cut = valid_lines(parsed), None
        if stream_limit and progress.events + n > stream_limit:
            good, cut = _admitted(good, stream_limit - progress.events)
        stopped = before(spark, "stops", batch_id) if on_stop == "hold" else None
        results = settle(dispatch(good, handler, mode, ordered=ordered, stopped=stopped), mode)
        if cut is not None:
            results = results.join(F.broadcast(cut), ["stream_id", "frame_id"], "left")
            kept = F.when(F.col("_cut") & (F.col("settled") == "committed"), F.lit("not_committed")).otherwise(F.col("settled"))
            results = results.withColumn("settled", kept).drop("_cut")
        results.write.mode("overwrite").parquet(f"{out}/results/batch={batch_id}")
        # Read back: the handlers must not run again for the commits.
        settled = spark.read.parquet(f"{out}/results/batch={batch_id}")
        ledger.commit(out, batch_id, coalesce_cursors(cursors_to_commit(settled), ["stream_id"]))
        progress.events += _handed_over(settled)
        if on_stop == "raise":
            raise_if_stopped(settled)
        else:
            stops = settled.filter("settled = 'stopped'").groupBy(*scope).agg(F.min("frame_id").alias("frame_id"))
            stops.write.mode("overwrite").parquet(f"{out}/stops/batch={batch_id}")

    writer = frames.writeStream.foreachBatch(process).option("checkpointLocation", f"{out}/checkpoint")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


committed = ledger.committed
reset = ledger.reset


def _handed_over(results: DataFrame) -> int:
    return results.filter(F.col("action") != HELD_BACK).agg(F.coalesce(F.sum("n_events"), F.lit(0))).first()[0]


def events_seen(spark: SparkSession, out: str) -> int:
    """Events of all batches handed to handlers so far: what a stream limit counts."""
    try:
        rows = spark.read.option("basePath", f"{out}/results").parquet(f"{out}/results/batch=*")
    except AnalysisException:  # no micro-batch has ended yet
        return 0
    return _handed_over(rows)


def distinct_events(events: DataFrame, delay: str, at: str = "received_at") -> DataFrame:
    """Drop events whose eid was seen within ``delay``: opt-in, as it needs a watermark."""
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark(["eid"])


def run_with_limits(
    query: StreamingQuery,
    *,
    timeout_secs: float = 0,
    stream_limit: int = 0,
    count: Callable[[], int] | None = None,
    poll_secs: float = 0.2,
) -> str:
    """Let a query run until it ends, times out or has seen ``stream_limit`` events.

    Returns ``ended``, ``timeout`` or ``limit``; 0 means no limit. ``count`` tells the events
    so far: that of :class:`Progress` runs nothing. :func:`consume` itself hands over no more than its limit.
    """
    if stream_limit and count is None:
        raise ValueError("a stream limit needs a count of events")
    begun = time.monotonic()
    while not query.awaitTermination(poll_secs):
        if timeout_secs and time.monotonic() - begun > timeout_secs:
            query.stop()
            return "timeout"
        if stream_limit and count() >= stream_limit:
            query.stop()
            return "limit"
    return "ended"


def report_stats(
    stats: Callable[[], DataFrame], report: Callable[[DataFrame], None], every_secs: float
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that reports subscription stats at most every n secs."""
    last = [float("-inf")]

    def step(_batch: DataFrame, _batch_id: int) -> None:
        now = time.monotonic()
        if now - last[0] >= every_secs:
            last[0] = now
            report(stats_report(stats()))

    return step


LIFECYCLE = T.StructType(
    [
        T.StructField("at", T.TimestampType()),
        T.StructField("query_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("detail", T.StringType()),
    ]
)


class LifecycleTable(StreamingQueryListener):
    """Appends started/connected/stopped rows of streaming queries to a table."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path
        self._connected: set[str] = set()
        self.n_stopped = 0

    def _append(self, query_id, run_id, event: str, detail: str | None = None) -> None:
        row = (datetime.now(timezone.utc), str(query_id), str(run_id), event, detail)
        self._spark.createDataFrame([row], LIFECYCLE).write.mode("append").parquet(self._path)

    def onQueryStarted(self, event):
        self._append(event.id, event.runId, "started")

    def onQueryProgress(self, event):
        progress = event.progress
        if str(progress.runId) not in self._connected:
            self._connected.add(str(progress.runId))
            self._append(progress.id, progress.runId, "connected")

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if str(event.runId) in self._connected:
            self._append(event.id, event.runId, "stream_ended")
        self._append(event.id, event.runId, "stopped", event.exception)
        self.n_stopped += 1
