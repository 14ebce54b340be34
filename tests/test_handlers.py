import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import types as T

from tidelog.model import business_event
from tidelog.operators import envelope as env, handlers as hd

from helpers import at, rows

# Workers cannot import test modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAYLOAD = T.StructType([T.StructField("count", T.LongType())])


def frames(spark, *items):
    """Items are (frame_id, event_type, partition, events or None)."""
    data = []
    for frame_id, event_type, partition, events in items:
        line = {"cursor": {"partition": partition, "offset": str(frame_id), "event_type": event_type, "cursor_token": "t"}}
        if events is not None:
            line["events"] = events
        data.append(("s", frame_id, json.dumps(line), at(frame_id), at(frame_id + 0.5)))
    df = spark.createDataFrame(data, "stream_id string, frame_id long, value string, started_at timestamp, completed_at timestamp")
    return env.valid_lines(env.parse_lines(df))


def by_frame(events, meta):
    return {2: (hd.ABORT_STREAM, "enough"), 4: hd.DO_NOT_COMMIT, 9: (hd.SHUT_DOWN, "bye")}.get(meta.frame_id, hd.COMMIT)


ITEMS = [(0, "a", "0", [{"count": 1}]), (1, "a", "1", []), (2, "a", "0", [{}]), (3, "a", "0", [{}, {}]), (4, "a", "1", [{}]), (5, "b", "0", [{}]), (6, "b", "0", None)]


@pytest.mark.parametrize("mode", list(hd.DISPATCH_SCOPES))
@pytest.mark.parametrize("ordered", [False, True])
def test_stops_hold_back_their_scope(spark, mode, ordered):
    results = hd.dispatch(frames(spark, *ITEMS), by_frame, mode, ordered=ordered)
    got = {r["frame_id"]: r["settled"] for r in hd.settle(results, mode).collect()}
    after = {"all_seq": {3, 4, 5}, "event_type_par": {3, 4}, "event_type_partition_par": {3}}[mode]
    free = {3: "committed", 4: "not_committed", 5: "committed"}
    want = {0: "committed", 1: "committed", 2: "stopped"} | {f: "held_back" if f in after else s for f, s in free.items()}
    assert got == want


def test_ordered_calls_follow_frame_ids(spark):
    seen = []

    def remember(events, meta):
        # One worker process per task: the list is that task's calls in order.
        seen.append(meta.frame_id)
        return hd.COMMIT, ",".join(map(str, seen))

    many = [(i, "a", "0", [{}]) for i in (5, 3, 8, 1, 0, 2)]
    out = hd.dispatch(frames(spark, *many).repartition(4), remember, ordered=True)
    longest = max((r["detail"] for r in out.collect()), key=len)
    assert longest == "0,1,2,3,5,8"


@pytest.mark.parametrize("mode, called", [("all_seq", [0, 1, 2]), ("event_type_par", [0, 1, 2, 5]), ("event_type_partition_par", [0, 1, 2, 4, 5])])
def test_no_call_after_a_stop(spark, tmp_path, mode, called):
    def noted(events, meta):
        (tmp_path / str(meta.frame_id)).touch()
        return by_frame(events, meta)

    results = hd.dispatch(frames(spark, *ITEMS), noted, mode, ordered=True)
    got = {r["frame_id"]: r["action"] for r in results.collect()}
    assert sorted(int(p.name) for p in tmp_path.iterdir()) == called
    assert sorted(f for f, a in got.items() if a == hd.HELD_BACK) == [f for f in range(6) if f not in called]


def test_handlers_by_event_type(spark):
    with pytest.raises(Exception, match="no handler for event type b"):
        hd.dispatch(frames(spark, *ITEMS), {"a": by_frame}).collect()
    with pytest.raises(Exception, match="unknown handler outcome"):
        hd.dispatch(frames(spark, *ITEMS), lambda events, meta: "maybe").collect()


def test_driver_raises_on_a_stop(spark):
    hd.raise_if_stopped(hd.settle(hd.dispatch(frames(spark, *ITEMS[:2]), by_frame)))
    with pytest.raises(hd.HandlerStopped, match="abort_stream at a/0 frame 2: enough"):
        hd.raise_if_stopped(hd.settle(hd.dispatch(frames(spark, *ITEMS), by_frame)))


def test_counts(spark):
    results = hd.dispatch(frames(spark, *ITEMS), by_frame, ordered=False).cache()
    assert rows(hd.events_handled(results)) == [("a", 5), ("b", 1)]
    got = rows(hd.processing_metrics(results), "event_type", "n_batches", "n_events")
    # The batch that stopped its scope does not count as processed events.
    assert got == [("a", 5, 4), ("b", 1, 1)]
    cursors = hd.cursors_to_commit(hd.settle(results))
    assert {r["frame_id"] for r in cursors.collect()} == {0, 1, 5}


def test_decode_error_hooks(spark):
    lines = frames(spark, (0, "a", "0", [{"count": 1}, {"count": "x"}, {}]))
    schema, count = business_event(PAYLOAD), lambda df: df.select("pos")
    assert rows(hd.typed_handler(lines, schema, count, ("count",), "drop")) == [(0,)]
    good, bad = hd.typed_handler(lines, schema, count, ("count",), "route")
    assert (good.count(), rows(bad, "pos", "error")) == (1, [(1, "count: string instead of bigint"), (2, "missing count")])
    with pytest.raises(Exception, match="event cannot be decoded"):
        hd.typed_handler(lines, schema, count, ("count",)).collect()
