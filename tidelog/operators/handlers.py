"""Dispatch of event batches to user functions, and what follows from their outcome.

A batch is one row (its events are an array of JSON texts), so a handler that looks at
one batch at a time needs no grouping: batches are handled where they are, in parallel
and with bounded memory, however the batches spread over scopes. Handlers whose calls
must follow each other within a scope ask for ``ordered=True``, which sorts each scope's
batches and streams them through the handler.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tidelog.model import ABORT_STREAM, COMMIT, DO_NOT_COMMIT, SHUT_DOWN
from tidelog.operators.joins import join_small
from tidelog.operators.envelope import decode_events, event_batches, explode_events
from tidelog.session import stored

# Dispatch modes and the columns that make a scope.
DISPATCH_SCOPES = {
    "all_seq": [],
    "event_type_par": ["event_type"],
    "event_type_partition_par": ["event_type", "partition"],
}
DEFAULT_DISPATCH = "event_type_partition_par"
ACTIONS = (COMMIT, DO_NOT_COMMIT, ABORT_STREAM, SHUT_DOWN)
# Not an outcome of a handler: it wasn't called any more.
HELD_BACK = "held_back"


@dataclass(frozen=True)
class BatchMeta:
    """What a handler is told about its batch."""

    stream_id: str
    event_type: str
    partition: str
    offset: int | None
    offset_text: str
    frame_id: int
    n_events: int
    started_at: pd.Timestamp
    completed_at: pd.Timestamp


# What of a batch goes into its result as it is.
_SEEN = ["stream_id", "event_type", "partition", "offset", "offset_text", "frame_id", "started_at"]

Handler = Callable[[list[str], BatchMeta], "str | tuple[str, str]"]

_RESULT = T.StructType(
    [
        T.StructField("stream_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("partition", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("offset_text", T.StringType()),
        T.StructField("frame_id", T.LongType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("n_events", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("action", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("t_handle_us", T.LongType()),
        T.StructField("t_decode_us", T.LongType()),
    ]
)


def _handler_for(handler: Handler | Mapping[str, Handler], event_type: str) -> Handler:
    if callable(handler):
        return handler
    if event_type not in handler:
        raise ValueError(f"no handler for event type {event_type}")
    return handler[event_type]


def dispatch(
    batches: DataFrame,
    handler: Handler | Mapping[str, Handler],
    mode: str = DEFAULT_DISPATCH,
    *,
    ordered: bool = True,
    stopped: DataFrame | None = None,
    decode: Callable[[str], object] | None = None,
) -> DataFrame:
    """Call the handler for every batch; one result row per batch with its action.

    ``handler`` is a function ``(events, meta) -> action`` or ``(action, detail)``, or a
    dictionary of them by event type. Frames without events are not handed over. With ``decode`` the handler
    gets what that makes of each event, and the time it takes is told apart.

    The calls of one scope come in order of frame_id from one task;
    ``all_seq`` then means a single task for everything, as its name says, and does not
    scale. Once a batch aborts the stream or shuts down, the handler isn't called again in
    its scope: later batches get the action ``held_back``, and so do batches of the scopes in ``stopped``,
    where it was stopped before. With ``ordered=False`` batches are handled where they are; the mode then only
    decides what :func:`settle` holds back, and calls in flight elsewhere aren't stopped.
    """
    scope = DISPATCH_SCOPES[mode]
    rows = event_batches(batches).select(
        *_SEEN, "completed_at", "events", F.coalesce("events_bytes", F.lit(0)).alias("n_bytes")
    )
    if stopped is None:
        rows = rows.withColumn("held", F.lit(False))
    else:
        known = stopped.select("stream_id", *scope).distinct().withColumn("held", F.lit(True))
        rows = join_small(rows, known, ["stream_id", *scope], "left").withColumn("held", F.coalesce("held", F.lit(False)))
    if ordered:
        place = ["stream_id", *scope] if scope else []
        rows = rows.repartition(*place) if place else rows.repartition(1)
        rows = rows.sortWithinPartitions(*(place or ["stream_id"]), "frame_id")

    place = ["stream_id", *(scope or [])]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        halted = None  # rows of a scope follow each other, so the last stop is enough
        for part in parts:
            out = []
            for r in part.itertuples(index=False):
                own = tuple(getattr(r, c) for c in place)
                offset = None if pd.isna(r.offset) else int(r.offset)
                seen = (r.stream_id, r.event_type, r.partition, offset, r.offset_text, r.frame_id)
                if r.held or (ordered and own == halted):
                    out.append((*seen, r.started_at, len(r.events), 0, HELD_BACK, None, 0, 0))
                    continue
                begun = time.perf_counter_ns()
                events = [decode(e) for e in r.events] if decode else list(r.events)
                decoding = (time.perf_counter_ns() - begun) // 1000 if decode else 0
                meta = BatchMeta(*seen, len(events), r.started_at, r.completed_at)
                begun = time.perf_counter_ns()
                outcome = _handler_for(handler, r.event_type)(events, meta)
                took = (time.perf_counter_ns() - begun) // 1000
                action, detail = outcome if isinstance(outcome, tuple) else (outcome, None)
                if action not in ACTIONS:
                    raise ValueError(f"unknown handler outcome: {action}")
                if action in (ABORT_STREAM, SHUT_DOWN):
                    halted = own
                out.append((*seen, r.started_at, len(events), r.n_bytes, action, detail, took, decoding))
            yield pd.DataFrame(out, columns=_RESULT.fieldNames()).astype({"offset": "Int64"})

    return rows.mapInPandas(run, _RESULT)


def typed_handler(
    batches: DataFrame,
    schema: T.StructType,
    handle: Callable[[DataFrame], DataFrame],
    required: tuple[str, ...] = (),
    on_decode_error: str = "fail",
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Decode the events of the batches and hand them on as a DataFrame.

    An event that cannot be decoded raises (``fail``), is left out (``drop``), or goes
    to a second DataFrame with its raw text and error (``route``).
    """
    decoded = decode_events(explode_events(event_batches(batches)), schema, required)
    bad = F.col("error").isNotNull()
    if on_decode_error == "fail":
        reason = F.concat(F.lit("event cannot be decoded: "), F.col("error"))
        checked = F.when(bad, F.raise_error(reason).cast("boolean")).otherwise(F.lit(True))
        return handle(decoded.filter(checked))
    if on_decode_error == "drop":
        return handle(decoded.filter(~bad))
    if on_decode_error == "route":
        return handle(decoded.filter(~bad)), decoded.filter(bad)
    raise ValueError(f"unknown on_decode_error: {on_decode_error}")


def settle(results: DataFrame, mode: str = DEFAULT_DISPATCH, n_rows: int | None = None) -> DataFrame:
    """Add ``settled``: ``committed``, ``not_committed``, ``stopped`` or ``held_back``.

    From the first abort or shut-down of a scope on nothing of that scope is committed:
    that batch stopped the scope and later ones are held back. Only ``commit`` yields a
    cursor. The results are stored first, as they are read twice and handlers must not
    run again; the first stop is aggregated per scope and joined back. ``n_rows`` is an
    upper bound of the scopes.
    """
    results = stored(results, "handled")
    scope = ["stream_id", *DISPATCH_SCOPES[mode]]
    stop = F.col("action").isin(ABORT_STREAM, SHUT_DOWN)
    stops = results.filter(stop).groupBy(*scope).agg(F.min("frame_id").alias("_stop"))
    after = F.col("frame_id") > F.col("_stop")
    settled = (
        F.when(after | (F.col("action") == HELD_BACK), F.lit(HELD_BACK))
        .when(stop, F.lit("stopped"))
        .when(F.col("action") == COMMIT, F.lit("committed"))
        .otherwise(F.lit("not_committed"))
    )
    return join_small(results, stops, scope, "left", n_rows).withColumn("settled", settled).drop("_stop")


def cursors_to_commit(settled: DataFrame) -> DataFrame:
    return settled.filter(F.col("settled") == "committed")


class HandlerStopped(RuntimeError):
    """A handler asked to abort the stream or to shut down."""


def raise_if_stopped(settled: DataFrame) -> None:
    """Raise on the driver if a handler stopped its scope; call after committing."""
    first = settled.filter(F.col("settled") == "stopped").orderBy("stream_id", "frame_id").limit(1).collect()
    if first:
        r = first[0]
        raise HandlerStopped(f"{r['action']} at {r['event_type']}/{r['partition']} frame {r['frame_id']}: {r['detail']}")


def processing_metrics(results: DataFrame, by: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Batches, events, bytes, and the times of handling and decoding per group.

    Events of a batch whose handler stopped are not counted as processed; batches that no
    handler was called for aren't counted at all.
    """
    processed = F.col("action").isin(COMMIT, DO_NOT_COMMIT)
    return results.filter(F.col("action") != HELD_BACK).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.sum(F.when(processed, F.col("n_events")).otherwise(0)).cast("long").alias("n_events"),
        F.sum("n_bytes").cast("long").alias("n_bytes"),
        F.sum("t_handle_us").cast("long").alias("t_handle_us"),
        F.sum("t_decode_us").cast("long").alias("t_decode_us"),
    )


def events_handled(results: DataFrame) -> DataFrame:
    """Events per event type that went through the handlers."""
    return results.filter(F.col("action") != HELD_BACK).groupBy("event_type").agg(F.sum("n_events").cast("long").alias("n_events"))
