"""Commits: coalescing, outcomes, ages, and cutting cursors into commits."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidelog.functions.times import SECOND
from tidelog.model import BEGIN, ETP, STREAM_DEFAULTS
from tidelog.operators.joins import join_null_safe, join_small
from tidelog.operators.segments import (
    CARRY_ROWS,
    carry_scan,
    chained_cuts,
    position_segment,
    segmented_scan,
)
from tidelog.session import stored


def safe_timeout_us(commit_timeout_secs: int) -> int:
    """How long a cursor may wait: a second less than the timeout, at least half a second.

    0 stands for the default of 60 s.
    """
    secs = commit_timeout_secs or STREAM_DEFAULTS["commit_timeout_secs"]
    return (secs - 1) * SECOND if secs > 1 else SECOND // 2


@dataclass(frozen=True)
class CommitStrategy:
    """``immediately``, ``latest_possible``, or ``after`` seconds / cursors / events."""

    kind: str
    seconds: int | None = None
    cursors: int | None = None
    events: int | None = None

    def __post_init__(self):
        if self.kind not in ("immediately", "latest_possible", "after"):
            raise ValueError(f"unknown commit strategy: {self.kind}")
        limits = (self.seconds, self.cursors, self.events)
        if self.kind == "after" and all(v is None for v in limits):
            raise ValueError("'after' needs seconds, cursors or events")
        if any(v == 0 for v in limits):
            raise ValueError("limits of a commit strategy must not be 0")

    @property
    def interval_secs(self) -> int | None:
        if self.kind == "immediately":
            return 0
        if self.kind == "latest_possible":
            return None
        return 10 if self.seconds is None else self.seconds


def derived_strategy(
    max_uncommitted_events: int = STREAM_DEFAULTS["max_uncommitted_events"],
    batch_limit: int = STREAM_DEFAULTS["batch_limit"],
) -> CommitStrategy:
    """The strategy of a consumer that names none: at the latest after a second or three
    quarters of the events that may stay uncommitted."""
    events = max(max_uncommitted_events * 3 // 4, 10)
    return CommitStrategy("after", seconds=1, cursors=max(events // max(batch_limit, 1), 1), events=events)


def coalesce_cursors(cursors: DataFrame, by: list[str] | None = None, order: str = "frame_id") -> DataFrame:
    """Only the last cursor of each partition is committed; the rest is counted.

    ``cursors`` has frame_id, started_at, offset and n_events, and offset_text if offsets may be any texts:
    the last one is the last received, whatever offsets look like.
    """
    text = [F.max_by("offset_text", order).alias("offset_text")] if "offset_text" in cursors.columns else []
    return cursors.groupBy(*(by or []), *ETP).agg(
        F.max_by("offset", order).alias("offset"),
        *text,
        F.min_by("frame_id", order).alias("first_frame_id"),
        F.max_by("frame_id", order).alias("last_frame_id"),
        F.min_by("started_at", order).alias("first_started_at"),
        F.max_by("started_at", order).alias("last_started_at"),
        F.count(F.lit(1)).alias("n_batches"),
        F.sum("n_events").cast("long").alias("n_events"),
    )


def cursor_ages(entries: DataFrame, attempted_at: Column, commit_timeout_secs: int = 60) -> DataFrame:
    """Age of the first and last cursor of each entry when it is committed."""
    at = F.unix_micros(attempted_at)
    first = at - F.unix_micros("first_started_at")
    return entries.select(
        "*",
        first.alias("first_age_us"),
        (at - F.unix_micros("last_started_at")).alias("last_age_us"),
        (first >= safe_timeout_us(commit_timeout_secs)).alias("warning"),
    )


def commit_outcomes(
    attempts: DataFrame,
    order_by: list[str],
    *,
    keys: tuple[str, ...] = ("subscription_id", *ETP),
    segments: int | None = None,
) -> DataFrame:
    """``committed``, or ``outdated`` if the same or a newer offset was committed before."""
    before = segmented_scan(attempts, keys, order_by, segments, max_before={"_before": F.col("offset")})
    outdated = F.coalesce(F.col("offset") <= F.col("_before"), F.lit(False))
    return before.select(
        *attempts.columns, F.when(outdated, F.lit("outdated")).otherwise(F.lit("committed")).alias("result")
    )


def with_result(outcomes: DataFrame, result: str) -> DataFrame:
    return outcomes.filter(F.col("result") == result)


def all_committed(outcomes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """True if every cursor was committed, also where there is none."""
    every = F.coalesce(F.bool_and(F.col("result") == "committed"), F.lit(True)).alias("all_committed")
    return outcomes.groupBy(*by).agg(every) if by else outcomes.agg(every)


def reset_cursors(
    commits: DataFrame, at: Column, to: DataFrame | None = None, subscription_id: str | None = None
) -> DataFrame:
    """Commit rows that set a subscription back, to be appended to the commits table.

    ``to`` has the wanted event_type, partition and offset, and subscription_id unless that
    is given apart; every row of it gives a commit row, also for a partition that was never
    committed (its stream is NULL then). Without ``to`` every partition is
    replayed from the beginning. ``reset`` marks them: see :func:`effective_commits`.
    The stream is the one that committed last.
    """
    keys = ["subscription_id", *ETP]
    held = commits.groupBy(*keys).agg(
        F.max_by("stream_id", F.struct("committed_at", "offset", "stream_id")).alias("stream_id")
    )
    if to is None:
        target = held.withColumn("offset", F.lit(BEGIN).cast("long"))
    else:
        if "subscription_id" not in to.columns:
            if subscription_id is None:
                raise ValueError("whose cursors are they? give subscription_id")
            to = to.withColumn("subscription_id", F.lit(subscription_id))
        target = to.select(*keys, "offset").join(held, keys, "left")
    return target.select(
        "subscription_id", "stream_id", *ETP, "offset", at.alias("committed_at"), F.lit(True).alias("reset")
    )


def effective_commits(commits: DataFrame, n_rows: int | None = None) -> DataFrame:
    """The committed offset per subscription and partition with resets in force.

    After the last reset counts the reset offset or a higher one committed since.
    ``n_rows`` is an upper bound of the partitions that were reset.
    """
    keys = ["subscription_id", *ETP]
    reset_at = commits.filter("reset").groupBy(*keys).agg(F.max("committed_at").alias("_reset_at"))
    since = F.col("_reset_at").isNull() | (F.col("committed_at") > F.col("_reset_at")) | (
        F.col("reset") & (F.col("committed_at") == F.col("_reset_at"))
    )
    return join_small(commits, reset_at, keys, "left", n_rows).filter(since).groupBy(*keys).agg(F.max("offset").alias("committed"))


# --- cutting cursors into commits -------------------------------------------------

_CUT_STATE = T.StructType(
    [
        T.StructField("n_batches", T.LongType()),
        T.StructField("n_events", T.LongType()),
        T.StructField("deadline", T.LongType()),
        T.StructField("next_at", T.LongType()),
    ]
)
_CUT_COLUMNS = [
    T.StructField("_opens", T.LongType()),
    T.StructField("_closed_before", T.StringType()),
    T.StructField("_at_before", T.LongType()),
    T.StructField("_closed_here", T.StringType()),
    T.StructField("_at_here", T.LongType()),
]
_NEVER = 1 << 62


def _cut_rule(strategy: CommitStrategy, safe_us: int, kept: list[str]):
    """The sequential rule over the cursors of one stream in order of arrival."""
    interval = None if strategy.interval_secs is None else strategy.interval_secs * SECOND
    max_events = strategy.events if strategy.kind == "after" and strategy.events else _NEVER
    max_cursors = strategy.cursors if strategy.kind == "after" and strategy.cursors else _NEVER
    always = strategy.kind == "immediately"

    def cut(pdf: pd.DataFrame, entry: tuple | None) -> tuple[pd.DataFrame, tuple]:
        # next_at: the interval clock; 0 means elapsed, so the first cursor goes at once.
        batches, events, deadline, next_at = entry or (0, 0, _NEVER, 0 if interval is not None else _NEVER)
        opens, closed_before, closed_here, at_before, at_here = [], [], [], [], []
        for now, started, n in zip(pdf["_arrived"].tolist(), pdf["_started"].tolist(), pdf["_n"].tolist()):
            before = before_at = here = here_at = None
            due = min(deadline, next_at)
            if batches and due < now:
                before, before_at = "deadline", due
                if interval is not None:
                    next_at = due + interval
                batches, events, deadline = 0, 0, _NEVER
            opens.append(int(batches == 0))
            batches, events = batches + 1, events + n
            deadline = min(deadline, started + safe_us)
            if always or deadline <= now:
                here = "deadline"
            elif events >= max_events:
                here = "events"
            elif batches >= max_cursors:
                here = "batches"
            elif next_at <= now:
                here = "deadline"
            if here:
                here_at = now
                if interval is not None:
                    next_at = now + interval
                batches, events, deadline = 0, 0, _NEVER
            closed_before.append(before)
            at_before.append(before_at)
            closed_here.append(here)
            at_here.append(here_at)
        out = pdf[kept].assign(
            _opens=opens,
            _closed_before=closed_before,
            _at_before=pd.array(at_before, dtype="Int64"),
            _closed_here=closed_here,
            _at_here=pd.array(at_here, dtype="Int64"),
        )
        return out, (batches, events, deadline, next_at)

    return cut


def _cut_by_deadline(cursors: DataFrame, keys: list[str], safe_us: int, segment_rows: int) -> DataFrame:
    """Cuts where only the safe timeout counts: pending cursors go at the earliest due time among them.

    A cursor is due at its frame start plus the timeout, but not before it arrives. The earliest due time from a
    cursor on, whatever comes later, is when a commit that starts there goes: later cursors aren't due before they
    arrive. The cursor that arrives at that very moment goes with it.
    """
    arrived = F.unix_micros("arrived_at")
    due = F.greatest(F.unix_micros("started_at") + safe_us, arrived)
    rows = cursors.withColumns({"_at": arrived, "_back": -F.col("seq"), "_due": -due})
    segment = position_segment("_back", segment_rows)
    rows = segmented_scan(rows, keys, ["_back"], segment, running_max={"_until": F.col("_due")})
    rows = rows.withColumn("_until", -F.col("_until"))
    cut = chained_cuts(rows, keys, "seq", "_at", "_until", through_limit=True, segment_rows=segment_rows)
    last = cut.groupBy(*keys).agg(F.max("_at").alias("_top"), F.max("piece").alias("_last"))
    went = (F.col("piece") < F.col("_last")) | (F.col("piece_until") <= F.col("_top"))
    return join_small(cut, last, keys, null_safe=True).select(
        *cursors.columns,
        (F.col("piece") + 1).alias("commit_no"),
        F.when(went, F.lit("deadline")).otherwise(F.lit("stream_end")).alias("trigger"),
        F.when(went, F.col("piece_until")).alias("triggered_us"),
    )


def cut_commits(
    cursors: DataFrame,
    strategy: CommitStrategy,
    *,
    commit_timeout_secs: int = 60,
    keys: tuple[str, ...] = ("stream_id",),
    segment_rows: int = CARRY_ROWS,
) -> DataFrame:
    """Give each cursor its ``commit_no`` and that commit's trigger and time.

    ``cursors`` has the keys, seq (order of arrival, nearly gapless), started_at,
    arrived_at and n_events. A commit falls due at the earliest of: its first cursor's
    frame start plus the safe timeout, its number of events, its number of cursors, and
    the strategy's interval since the commit before; a due time that passes between two
    cursors commits before the second one. What is pending at the end has trigger
    ``stream_end`` and no time.

    A stream commits across its partitions, which is one chain of cursors; with
    ``keys=("stream_id", "event_type", "partition")`` each partition commits on its own.
    ``immediately`` needs no chain at all, and ``latest_possible`` runs along pointers (:func:`chained_cuts`),
    for which arrived_at must not decrease along seq. The clock of the others restarts at moments that no
    cursor marks, so their rule is carried from segment to segment.
    """
    keys = list(keys)
    if strategy.kind == "immediately":
        segment = position_segment("seq", segment_rows)
        numbered = segmented_scan(cursors, keys, ["seq"], segment, row_number="commit_no")
        return numbered.withColumn("trigger", F.lit("deadline")).withColumn(
            "triggered_us", F.unix_micros("arrived_at")
        )

    if strategy.kind == "latest_possible":
        return _cut_by_deadline(cursors, keys, safe_timeout_us(commit_timeout_secs), segment_rows)

    rows = cursors.withColumns(
        {
            "_arrived": F.unix_micros("arrived_at"),
            "_started": F.unix_micros("started_at"),
            "_n": F.col("n_events").cast("long"),
        }
    )
    cuts = carry_scan(
        rows,
        keys,
        "seq",
        _cut_rule(strategy, safe_timeout_us(commit_timeout_secs), cursors.columns),
        _CUT_STATE,
        T.StructType([*cursors.schema.fields, *_CUT_COLUMNS]),
        segment_rows=segment_rows,
    )
    segment = position_segment("seq", segment_rows)
    numbered = segmented_scan(cuts, keys, ["seq"], segment, running_sum={"commit_no": F.col("_opens")})
    # Read twice below: the rule must not run twice.
    numbered = stored(numbered, "cuts")
    closings = (
        numbered.select(
            *keys,
            F.explode(
                F.array(
                    F.struct(
                        F.col("commit_no"), F.col("_closed_here").alias("trigger"), F.col("_at_here").alias("triggered_us")
                    ),
                    F.struct(
                        (F.col("commit_no") - 1).alias("commit_no"),
                        F.col("_closed_before").alias("trigger"),
                        F.col("_at_before").alias("triggered_us"),
                    ),
                )
            ).alias("c"),
        )
        .select(*keys, "c.*")
        .filter(F.col("trigger").isNotNull())
    )
    return (
        join_null_safe(numbered.select(*cursors.columns, "commit_no"), closings, [*keys, "commit_no"], "left")
        .withColumn("trigger", F.coalesce("trigger", F.lit("stream_end")))
    )


def commit_table(cut: DataFrame, keys: tuple[str, ...] = ("stream_id",)) -> DataFrame:
    """One row per commit and partition: the cursor that is sent, and what it covers."""
    extra = [k for k in keys if k not in ETP]
    return coalesce_cursors(cut, [*extra, "commit_no", "trigger", "triggered_us"], order="seq")


def commit_metrics(cut: DataFrame, by: tuple[str, ...] = ("stream_id",)) -> DataFrame:
    """Commits, batches and events per trigger."""
    per_commit = cut.groupBy(*by, "commit_no", "trigger").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_events").alias("e")
    )
    return per_commit.groupBy(*by, "trigger").agg(
        F.count(F.lit(1)).alias("n_commits"),
        F.sum("n").cast("long").alias("n_batches"),
        F.sum("e").cast("long").alias("n_events"),
        F.max("n").alias("max_batches"),
        F.max("e").cast("long").alias("max_events"),
    )
