"""Keyed state over streams: partition activity, stream liveness, handler slots.

Every processor works on event time (replays, tests; timers fire as the watermark
moves) or on processing time (live use).

Activity and liveness ask only for the quiet times between rows. Each Arrow batch of a key is
reduced to the spans in which it was never quiet for long, and spans are merged as
they come: in any order, and with no row kept. A handler slot calls a user function for
each row in order, so it sorts a key's rows of a micro-batch, which the source's rate
options bound.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidelog.functions.times import SECOND
from tidelog.model import NO_EVENTS_WARNING_SECS, NO_FRAMES_WARNING_SECS, PARTITION_INACTIVITY_SECS
from tidelog.operators.liveness import StreamDeadPolicy

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Keyed state with timers needs the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _micros(times: pd.Series) -> list[int]:
    return (pd.to_datetime(times).astype("datetime64[us]").astype("int64")).tolist()


def _in_order(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values(order)


class Spans:
    """Stretches of time without a quiet time of ``limit`` microseconds or more; a monoid under :meth:`add`."""

    def __init__(self, limit: int):
        self._limit = limit
        self.starts = self.ends = np.empty(0, np.int64)

    def add(self, starts: np.ndarray, ends: np.ndarray) -> None:
        starts, ends = np.concatenate((self.starts, starts)), np.concatenate((self.ends, ends))
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], np.maximum.accumulate(ends[order])
        opens = np.concatenate(([True], starts[1:] - ends[:-1] >= self._limit))[: len(starts)]
        closes = np.concatenate((opens[1:], [True]))[: len(starts)]
        self.starts, self.ends = starts[opens], ends[closes]

    def add_times(self, times: pd.Series) -> None:
        at = np.sort(pd.to_datetime(times).astype("datetime64[us]").astype("int64").to_numpy())
        self.add(at, at)

    @property
    def last(self) -> int:
        return int(self.ends[-1])

    def quiet(self, since: int | None, limit: int) -> list[int]:
        """Where quiet times of ``limit`` or more began; ``since`` is the last time heard before."""
        ends, starts = self.ends, self.starts
        if since is not None:
            # What came late, before that time, was not quiet for it.
            ends = np.maximum(np.concatenate(([since], ends)), since)
        elif len(starts):
            starts = starts[1:]
        return ends[: len(starts)][starts - ends[: len(starts)] >= limit].tolist()


def _due_ms(at_us: int) -> int:
    """First millisecond strictly after a time in microseconds."""
    return at_us // 1000 + 1


class _Timed(StatefulProcessor):
    event_time = False

    def _now_ms(self, timerValues, expiredTimerInfo) -> int:
        """How far time has come when a timer fires, which may be past its due time."""
        clock = timerValues.getCurrentWatermarkInMs if self.event_time else timerValues.getCurrentProcessingTimeInMs
        return max(clock(), expiredTimerInfo.getExpiryTimeInMs())

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("state", self.STATE)

    def _rearm(self, at_ms: int) -> None:
        for old in list(self._handle.listTimers()):
            self._handle.deleteTimer(old)
        self._handle.registerTimer(at_ms)

    def close(self) -> None:
        pass


class PartitionActivity(_Timed):
    """Activated / deactivated transitions of a partition."""

    STATE = "since bigint, last bigint"
    OUTPUT = "event_type string, partition string, transition string, at_us bigint, active_us bigint"

    def __init__(self, timeout_secs: int = PARTITION_INACTIVITY_SECS, at: str = "received_at"):
        self._timeout, self._at = timeout_secs * SECOND, at

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        since, last = self._state.get() if self._state.exists() else (None, None)
        spans = Spans(self._timeout + 1)
        for part in rows:
            spans.add_times(part[self._at])
        out = []
        for start, end in zip(spans.starts.tolist(), spans.ends.tolist()):
            if last is not None and start - last > self._timeout:
                out.append((*key, "deactivated", last, last - since))
                since = None
            if since is None:
                out.append((*key, "activated", start, None))
                since = start
            last = end if last is None else max(last, end)
        self._state.update((since, last))
        self._rearm(_due_ms(last + self._timeout))
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self._state.exists():
            since, last = self._state.get()
            self._state.clear()
            yield self._frame([(*key, "deactivated", last, last - since)])

    @staticmethod
    def _frame(out: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=["event_type", "partition", "transition", "at_us", "active_us"])
        return frame.astype({"at_us": "int64", "active_us": "Int64"})


class StreamLiveness(_Timed):
    """Warns of, and declares dead, streams that go quiet while they are watched.

    Each limit is told once per quiet period: ``told`` is a bit set of limits.
    """

    STATE = "last_frame bigint, last_events bigint, told bigint"
    OUTPUT = "stream_id string, severity string, missing string, last_us bigint"

    def __init__(
        self,
        policy: StreamDeadPolicy = StreamDeadPolicy(),
        warn_no_frames_secs: int = NO_FRAMES_WARNING_SECS,
        warn_no_events_secs: int = NO_EVENTS_WARNING_SECS,
        at: str = "started_at",
    ):
        self._at = at
        self._limits = [
            ("warning", "frames", warn_no_frames_secs * SECOND),
            ("warning", "events", warn_no_events_secs * SECOND),
        ]
        if policy.kind != "never":
            missing = "frames" if policy.kind == "no_frames_for" else "events"
            # Dead is beyond the limit, a warning is due at it.
            self._limits.append(("dead", missing, policy.seconds * SECOND + 1))

    def _tell(self, key, last: dict, told: int, now: int, out: list) -> int:
        for i, (severity, missing, limit) in enumerate(self._limits):
            if not told >> i & 1 and now - last[missing] >= limit:
                out.append((key[0], severity, missing, last[missing]))
                told |= 1 << i
        return told

    def _keep(self, last: dict, told: int) -> None:
        self._state.update((last["frames"], last["events"], told))
        for old in list(self._handle.listTimers()):
            self._handle.deleteTimer(old)
        due = [last[m] + limit for i, (_, m, limit) in enumerate(self._limits) if not told >> i & 1]
        if due:
            self._handle.registerTimer(-(-min(due) // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        least = min(limit for _, _, limit in self._limits)
        heard = {"frames": Spans(least), "events": Spans(least)}
        for part in rows:
            heard["frames"].add_times(part[self._at])
            batches = part[self._at][part["kind"] == "batch"]
            if len(batches):
                heard["events"].add_times(batches)
        first, now = int(heard["frames"].starts[0]), heard["frames"].last
        # A stream is watched from its first frame on.
        before, told = {"frames": first, "events": first}, 0
        if self._state.exists():
            frame, events, told = self._state.get()
            before = {"frames": frame, "events": events}
        last = {m: max(before[m], spans.last) if len(spans.ends) else before[m] for m, spans in heard.items()}
        out: list[tuple] = []
        for i, (severity, missing, limit) in enumerate(self._limits):
            quiet = heard[missing].quiet(before[missing], limit)
            # The period that was open before may have been told already.
            out += [(key[0], severity, missing, at) for at in quiet if not (told >> i & 1 and at == before[missing])]
            if len(heard[missing].ends):
                told &= ~(1 << i)
        told = self._tell(key, last, told, max(now, last["frames"]), out)
        self._keep(last, told)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        frame, events, told = self._state.get()
        last = {"frames": frame, "events": events}
        out: list[tuple] = []
        # Everything due by now is told here: a timer set for a past time would wait for
        # the next micro-batch.
        told = self._tell(key, last, told, self._now_ms(timerValues, expiredTimerInfo) * 1000, out)
        self._keep(last, told)
        yield self._frame(out)

    @staticmethod
    def _frame(out: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=["stream_id", "severity", "missing", "last_us"])
        return frame.astype({"last_us": "int64"})


class HandlerSlot(_Timed):
    """A handler with state per scope: created on demand, told once when it goes idle.

    ``handle(state, batch) -> state`` updates a JSON-able state with one batch, given as
    a dictionary of its columns. ``on_inactive(state, idle_us) -> bool`` says whether the
    handler stays alive; otherwise its state is gone and the next batch starts anew.
    """

    STATE = "state string, last bigint, notified boolean, alive boolean"
    OUTPUT = "event_type string, partition string, what string, at_us bigint, state string"

    def __init__(
        self,
        handle: Callable[[dict | None, dict], dict],
        on_inactive: Callable[[dict, int], bool],
        inactivity_secs: int,
        at: str = "started_at",
        order: str = "frame_id",
    ):
        self._handle_batch, self._on_inactive = handle, on_inactive
        self._timeout, self._at, self._order = inactivity_secs * SECOND, at, order

    def _idle(self, key, state, last, out) -> tuple[dict | None, bool]:
        keep = self._on_inactive(state, self._timeout)
        out.append((*key, "kept" if keep else "killed", last, json.dumps(state)))
        return (state, True) if keep else (None, False)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state, last, notified = None, None, False
        if self._state.exists():
            text, last, notified, alive = self._state.get()
            state = json.loads(text) if alive else None
        out = []
        got = _in_order(rows, [self._order])
        for at, batch in zip(_micros(got[self._at]), got.to_dict("records")):
            if state is not None and not notified and at - last > self._timeout:
                state, notified = self._idle(key, state, last, out)
            if state is None:
                out.append((*key, "created", at, None))
            state = self._handle_batch(state, batch)
            last, notified = at, False
        self._state.update((json.dumps(state), last, notified, True))
        self._rearm(_due_ms(last + self._timeout))
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        text, last, notified, alive = self._state.get()
        out: list[tuple] = []
        if alive and not notified:
            state, notified = self._idle(key, json.loads(text), last, out)
            self._state.update((json.dumps(state), last, notified, state is not None))
        yield self._frame(out)

    @staticmethod
    def _frame(out: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=["event_type", "partition", "what", "at_us", "state"])
        return frame.astype({"at_us": "int64"})


def with_state(
    rows: DataFrame,
    keys: list[str],
    processor: _Timed,
    *,
    event_time: str | None = None,
    delay: str = "0 seconds",
) -> DataFrame:
    """Run a processor over a stream, by event time if a column is named."""
    use_state_store(rows.sparkSession)
    processor.event_time = event_time is not None
    if event_time is None:
        return rows.groupBy(*keys).transformWithStateInPandas(
            processor, processor.OUTPUT, "Append", "ProcessingTime"
        )
    return (
        rows.withWatermark(event_time, delay)
        .groupBy(*keys)
        .transformWithStateInPandas(processor, processor.OUTPUT, "Append", "EventTime")
    )


def partition_activity(events: DataFrame, timeout_secs: int = PARTITION_INACTIVITY_SECS, at: str = "received_at", **time) -> DataFrame:
    return with_state(events.select("event_type", "partition", at), ["event_type", "partition"], PartitionActivity(timeout_secs, at), **time)


def stream_liveness(lines: DataFrame, policy: StreamDeadPolicy = StreamDeadPolicy(), at: str = "started_at", **time) -> DataFrame:
    return with_state(lines.select("stream_id", "kind", at), ["stream_id"], StreamLiveness(policy, at=at), **time)
