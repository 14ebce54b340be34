"""Metrics tables, and live metrics through ``DataFrame.observe``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQueryListener


def stream_metrics(lines: DataFrame, window: str = "1 day") -> DataFrame:
    """Lines and bytes per time window and kind, with how long lines took to arrive.

    ``lines`` has value, kind, has_info, n_events, started_at and completed_at.
    """
    took = F.unix_micros("completed_at") - F.unix_micros("started_at")
    n_bytes = F.octet_length("value")
    return (
        lines.groupBy(F.window("started_at", window).alias("w"), "kind")
        .agg(
            F.count(F.lit(1)).alias("n_frames"),
            F.count_if("has_info").alias("n_info"),
            F.sum("n_events").cast("long").alias("n_events"),
            F.sum(n_bytes).cast("long").alias("n_bytes"),
            F.max(n_bytes).cast("long").alias("max_bytes"),
            F.sum(took).cast("long").alias("sum_took_us"),
            F.max(took).cast("long").alias("max_took_us"),
            F.percentile_approx(took, 0.5, 10000).cast("long").alias("median_took_us"),
        )
        .select(F.col("w.start").alias("window_start"), "*")
        .drop("w")
    )


def commit_attempt_metrics(outcomes: DataFrame, by: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Committed and not committed cursors per group."""
    return outcomes.groupBy(*by).agg(
        F.count_if(F.col("result") == "committed").alias("n_committed"),
        F.count_if(F.col("result") != "committed").alias("n_not_committed"),
    )


# Accuracy of the sketches: about 1 in K of the ranks.
SKETCH_K = 800


def attempt_windows(attempts: DataFrame, window: str = "1 day", by: tuple[str, ...] = ()) -> DataFrame:
    """Attempts to commit per time window and outcome, with a sketch of the times they took.

    ``attempts`` has at (TIMESTAMP), outcome (``committed``, ``not_committed``, or ``failed``: there may be a
    retry), n_cursors and took_us. Rows of windows can be merged (:func:`merged_windows`), so late windows are added
    without reading attempts again.
    """
    return (
        attempts.groupBy(F.window("at", window).alias("w"), *by, "outcome")
        .agg(
            F.count(F.lit(1)).alias("n_attempts"),
            F.sum("n_cursors").cast("long").alias("n_cursors"),
            F.sum("took_us").cast("long").alias("sum_took_us"),
            F.max("took_us").cast("long").alias("max_took_us"),
            F.kll_sketch_agg_bigint(F.col("took_us"), SKETCH_K).alias("took"),
        )
        .select(F.col("w.start").alias("window_start"), "*")
        .drop("w")
    )


def merged_windows(windows: DataFrame, by: tuple[str, ...] = ("outcome",)) -> DataFrame:
    """Rows of :func:`attempt_windows` merged into one per group."""
    return windows.groupBy(*by).agg(
        F.sum("n_attempts").cast("long").alias("n_attempts"),
        F.sum("n_cursors").cast("long").alias("n_cursors"),
        F.sum("sum_took_us").cast("long").alias("sum_took_us"),
        F.max("max_took_us").alias("max_took_us"),
        F.kll_merge_agg_bigint("took", SKETCH_K).alias("took"),
    )


def with_quantiles(windows: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """Quantiles of the times, each as a column, instead of the sketch."""
    found = {name: F.kll_sketch_get_quantile_bigint("took", F.lit(q)) for name, q in quantiles.items()}
    return windows.withColumns(found).drop("took")


# Names under which live metrics are observed.
LIVE_METRICS = ("frames_received", "batches_received", "keep_alives_received", "infos_received", "events_received", "bytes_received")


def _live():
    return [
        F.count(F.lit(1)).alias("frames_received"),
        F.count_if(F.col("kind") == "batch").alias("batches_received"),
        F.count_if(F.col("kind") == "keep_alive").alias("keep_alives_received"),
        F.count_if("has_info").alias("infos_received"),
        F.sum("n_events").alias("events_received"),
        F.sum(F.octet_length("value")).alias("bytes_received"),
    ]


def observed(lines: DataFrame, name: str | Observation = "lines") -> DataFrame:
    """The same lines, counted while they pass: no second pass over them."""
    return lines.observe(name, *_live())


class MetricsReceiver(StreamingQueryListener):
    """Hands the observed metrics of every micro-batch to a user function.

    ``receive(name, batch_id, values)``.
    """

    def __init__(self, receive: Callable[[str, int, dict], None]):
        self._receive = receive

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        for name, row in event.progress.observedMetrics.items():
            self._receive(name, event.progress.batchId, row.asDict())

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
