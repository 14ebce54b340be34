import json
import random
import sys
import time

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidelog.operators import envelope as env, handlers as hd, liveness
from tidelog.operators.metrics import MetricsReceiver, observed
from tidelog.sources import frames as fr, log as lg
from tidelog.streaming import consume as sc, ledger, state as ss

from helpers import at, rows, us

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FRAMES = "stream_id string, frame_id long, value string, started_at timestamp, completed_at timestamp"


def line(partition, offset, events):
    cursor = {"partition": partition, "offset": str(offset), "event_type": "e", "cursor_token": "t"}
    return json.dumps({"cursor": cursor} | ({} if events is None else {"events": events}))


def write(spark, path, data, schema):
    """Append one file; a stream takes files in order of their time."""
    time.sleep(0.05)
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)


def run(stream, path):
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", path + "/ck").trigger(availableNow=True).start(path + "/out")
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path + "/out")


def test_activity_over_micro_batches(spark, tmp_path):
    schema, src = "event_type string, partition string, received_at timestamp", str(tmp_path / "in")
    for secs in ([0, 50], [100, 300], [310]):
        write(spark, src, [("e", "0", at(s)) for s in secs] + [("e", "1", at(secs[0]))], schema)
    stream = lg.stream_log(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=1)
    got = run(ss.partition_activity(stream, 90, event_time="received_at", delay="1 hour"), str(tmp_path))
    mine = got.filter("partition = '0'").orderBy("at_us", "transition").collect()
    assert [(r["transition"], r["at_us"], r["active_us"]) for r in mine] == [
        ("activated", us(0), None),
        ("deactivated", us(100), 100_000_000),
        ("activated", us(300), None),
    ]


def test_liveness_tells_each_limit_once(spark, tmp_path):
    src = str(tmp_path / "in")
    schema = "stream_id string, kind string, started_at timestamp"
    write(spark, src, [("s", "batch", at(0)), ("s", "keep_alive", at(25)), ("s", "keep_alive", at(50))], schema)
    write(spark, src, [("s", "keep_alive", at(75)), ("s", "batch", at(120)), ("s", "batch", at(121))], schema)
    lines = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    policy = liveness.StreamDeadPolicy("no_events_for", 100)
    got = run(ss.stream_liveness(lines, policy, event_time="started_at", delay="1 hour"), str(tmp_path))
    assert rows(got, "severity", "missing", "last_us") == sorted(
        [("warning", "events", us(0)), ("warning", "frames", us(75)), ("dead", "events", us(0))], key=repr
    )


def counted(state, batch):
    return {"n": (state or {"n": 0})["n"] + 1}


def never(state, idle_us):
    return False


def always(state, idle_us):
    return True


@pytest.mark.parametrize("keep, want", [(never, ["created", "killed", "created"]), (always, ["created", "kept"])])
def test_handler_slots(spark, tmp_path, keep, want):
    src = str(tmp_path / "in")
    schema = "event_type string, partition string, frame_id long, started_at timestamp"
    write(spark, src, [("e", "0", 0, at(0)), ("e", "0", 1, at(10))], schema)
    write(spark, src, [("e", "0", 2, at(100)), ("e", "0", 3, at(101))], schema)
    frames = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    slots = ss.with_state(frames, ["event_type", "partition"], ss.HandlerSlot(counted, keep, 60), event_time="started_at", delay="1 hour")
    got = run(slots, str(tmp_path)).collect()
    assert sorted(r["what"] for r in got) == sorted(want)
    idle = next(r for r in got if r["what"] in ("kept", "killed"))
    assert (json.loads(idle["state"]), idle["at_us"]) == ({"n": 2}, us(10))


def stop_at_three(events, meta):
    return (hd.ABORT_STREAM, "three") if meta.frame_id == 3 else hd.COMMIT


def frame_stream(spark, src):
    return spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)


def test_consume_commits_and_stops(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, src, [("s", 0, line("0", 4, [{}]), at(0), at(0)), ("s", 1, line("1", 2, None), at(1), at(1)), ("s", 2, "junk", at(1), at(1))], FRAMES)
    write(spark, src, [("s", i, line("0", 4 + i, [{}]), at(i), at(i)) for i in (2, 3, 4)], FRAMES)
    query = sc.consume(frame_stream(spark, src), stop_at_three, out)
    with pytest.raises(Exception, match="abort_stream at e/0 frame 3: three"):
        query.awaitTermination()
    assert rows(sc.committed(spark, out)) == [("e", "0", 6, "6")]
    assert spark.read.parquet(out + "/bad_lines/batch=*").count() == 1
    settled = spark.read.parquet(out + "/results/batch=*")
    assert rows(settled, "frame_id", "settled") == [(0, "committed"), (2, "committed"), (3, "stopped"), (4, "held_back")]


def test_batch_and_stream_agree_on_lines(spark, tmp_path):
    src = tmp_path / "lines"
    src.mkdir()
    (src / "a.txt").write_text("\n".join([line("0", i, [{"i": i}]) for i in range(5)]) + "\n\n")
    stream = run(env.explode_events(env.event_batches(env.valid_lines(env.parse_lines(fr.stream_lines(spark, str(src)))))), str(tmp_path))
    batch = env.explode_events(env.event_batches(env.valid_lines(env.parse_lines(fr.read_lines(spark, str(src))))))
    assert rows(stream, "offset", "event") == rows(batch, "offset", "event")


def test_distinct_events(spark, tmp_path):
    src = str(tmp_path / "in")
    write(spark, src, [("a", at(0)), ("b", at(1)), ("a", at(5))], "eid string, received_at timestamp")
    write(spark, src, [("b", at(6))], "eid string, received_at timestamp")
    events = frame_stream(spark, src)
    assert rows(run(sc.distinct_events(events, "1 hour"), str(tmp_path)), "eid") == [("a",), ("b",)]


def test_limits_lifecycle_reports_and_live_metrics(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "life")
    for i in range(4):
        write(spark, src, [("s", i, line("0", i, [{}, {}]), at(i), at(i))], FRAMES)
    seen, reports = [], []
    receiver, life = MetricsReceiver(lambda name, batch, values: seen.append((name, values))), sc.LifecycleTable(spark, out)
    stats = lambda: spark.createDataFrame([("e", None), ("f", 3)], "event_type string, unconsumed long")
    report = sc.report_stats(stats, lambda df: reports.append(rows(df)), every_secs=3600)
    spark.streams.addListener(receiver)
    spark.streams.addListener(life)
    try:
        lines = observed(env.parse_lines(frame_stream(spark, src)), "lines")

        passed = []

        def step(batch, batch_id):
            passed.append(batch.count())
            report(batch, batch_id)

        query = lines.writeStream.foreachBatch(step).option("checkpointLocation", str(tmp_path / "ck")).start()
        # A rate of one line per trigger keeps the overshoot small.
        assert sc.run_with_limits(query, stream_limit=3, timeout_secs=120, count=lambda: sum(passed)) == "limit"
        deadline = time.time() + 20
        while time.time() < deadline and not (seen and rows(spark.read.parquet(out)) and "stopped" in {r["event"] for r in spark.read.parquet(out).collect()}):
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(receiver)
        spark.streams.removeListener(life)
    # Later micro-batches come before the next report is due.
    assert reports == [[("e", 0), ("f", 3)]]
    assert {r["event"] for r in spark.read.parquet(out).collect()} == {"started", "connected", "stream_ended", "stopped"}
    idle = frame_stream(spark, src).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck2")).start()
    assert sc.run_with_limits(idle, timeout_secs=3) == "timeout"
    ended = frame_stream(spark, src).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck3")).trigger(availableNow=True).start()
    assert sc.run_with_limits(ended) == "ended"
    with pytest.raises(ValueError, match="count of events"):
        sc.run_with_limits(ended, stream_limit=1)


def test_live_metrics_count_what_passes(spark, tmp_path):
    src = str(tmp_path / "in")
    write(spark, src, [("s", 0, line("0", 0, [{}, {}]), at(0), at(0)), ("s", 1, line("0", 1, None), at(1), at(1))], FRAMES)
    seen = []
    receiver = MetricsReceiver(lambda name, batch, values: seen.append((name, values)))
    spark.streams.addListener(receiver)
    try:
        run(observed(env.parse_lines(frame_stream(spark, src)), "lines").select("value"), str(tmp_path))
        deadline = time.time() + 20
        while time.time() < deadline and not seen:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(receiver)
    name, values = seen[0]
    assert name == "lines"
    assert (values["frames_received"], values["batches_received"], values["keep_alives_received"], values["events_received"]) == (2, 1, 1, 2)


def test_processing_time_state(spark, tmp_path):
    """Live use: the clock, not the data, decides when a partition is idle."""
    src = str(tmp_path / "in")
    write(spark, src, [("e", "0", at(0))], "event_type string, partition string, received_at timestamp")
    stream = lg.stream_log(spark, src, spark.read.parquet(src).schema)
    now = stream.withColumn("received_at", F.current_timestamp())
    query = (
        ss.partition_activity(now, 1).writeStream.format("memory").queryName("live_activity").option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(processingTime="1 second").start()
    )
    try:
        deadline = time.time() + 40
        while time.time() < deadline and spark.table("live_activity").count() < 2:
            time.sleep(0.5)
        assert [r["transition"] for r in spark.table("live_activity").collect()] == ["activated", "deactivated"]
    finally:
        query.stop()


def numbered(events, meta):
    return (hd.ABORT_STREAM, "enough") if meta.frame_id == 2 and meta.partition == "0" else hd.COMMIT


def test_opaque_offsets_resets_and_snapshots(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "SNAPSHOT_EVERY", 3)
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    names = {"0": lambda i: f"00{9 - i}-x", "1": str}
    for i in range(8):
        write(spark, src, [("s", 2 * i + int(p), line(p, name(i), [{}]), at(i), at(i)) for p, name in names.items()], FRAMES)
    sc.consume(frame_stream(spark, src), commit_any, out).awaitTermination()
    assert rows(sc.committed(spark, out)) == [("e", "0", None, "002-x"), ("e", "1", 7, "7")]
    # Two snapshots and the epochs since the last but one: nothing grows with the length of the stream.
    assert [len([*(tmp_path / "out" / "ledger" / k).glob("epoch=*")]) for k in ("snapshot", "tail")] == [2, 6]
    to = spark.createDataFrame([("e", "0", "005-x"), ("e", "1", "begin"), ("f", "9", "4")], "event_type string, partition string, offset string")
    sc.reset(spark, out, to)
    assert rows(sc.committed(spark, out)) == [("e", "0", None, "005-x"), ("e", "1", -1, "begin"), ("f", "9", 4, "4")]
    for i in range(8, 12):
        write(spark, src, [("s", 2 * i, line("1", i - 6, [{}]), at(i), at(i))], FRAMES)
    sc.consume(frame_stream(spark, src), commit_any, out).awaitTermination()
    assert rows(sc.committed(spark, out)) == [("e", "0", None, "005-x"), ("e", "1", 5, "5"), ("f", "9", 4, "4")]


def commit_any(events, meta):
    return hd.COMMIT


@pytest.mark.parametrize("limit, kept", [(5, [(0, 2), (1, 2), (2, 1)]), (4, [(0, 2), (1, 2)]), (99, [(i, 2) for i in range(6)])])
def test_exactly_the_stream_limit(spark, tmp_path, limit, kept):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in (0, 3):
        write(spark, src, [("s", k, line("0", k, [{}, {}]), at(k), at(k)) for k in range(i, i + 3)], FRAMES)
    progress = sc.Progress()
    query = sc.consume(frame_stream(spark, src), commit_any, out, stream_limit=limit, progress=progress)
    sc.run_with_limits(query, stream_limit=limit, count=progress.count)
    results = spark.read.parquet(out + "/results/batch=*")
    assert rows(results.filter("n_events > 0"), "frame_id", "n_events") == kept
    assert progress.count() == sc.events_seen(spark, out) == min(limit, 12)
    # A line of which some events are left is not committed.
    assert rows(sc.committed(spark, out), "committed") == [(max(f for f, n in kept if n == 2),)]


def test_stops_outlive_micro_batches_and_restarts(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(0, 6, 2):
        write(spark, src, [("s", i + k, line(str(p), i + k, [{}]), at(i), at(i)) for k in (0, 1) for p in (k,)], FRAMES)
    sc.consume(frame_stream(spark, src), numbered, out, on_stop="hold").awaitTermination()
    write(spark, src, [("s", 6, line("0", 6, [{}]), at(6), at(6)), ("s", 7, line("1", 7, [{}]), at(7), at(7))], FRAMES)
    sc.consume(frame_stream(spark, src), numbered, out, on_stop="hold").awaitTermination()
    got = {r["frame_id"]: (r["action"], r["settled"]) for r in spark.read.parquet(out + "/results/batch=*").collect()}
    assert got[2] == ("abort_stream", "stopped") and got[4] == got[6] == ("held_back", "held_back")
    assert all(got[i] == ("commit", "committed") for i in (0, 1, 3, 5, 7))
    assert rows(sc.committed(spark, out), "partition", "committed") == [("0", 0), ("1", 7)]


@pytest.mark.parametrize("seed", range(30))
def test_spans_are_a_monoid(seed):
    rnd = random.Random(seed)
    times, limit = [rnd.randrange(300) for _ in range(rnd.randrange(1, 60))], rnd.randrange(1, 20)
    cut = rnd.randrange(len(times))
    spans = ss.Spans(limit)
    for part in (times[:cut], times[cut:]):
        spans.add_times(pd.to_datetime(pd.Series(part, dtype="int64"), unit="us"))
    want = []
    for t in sorted(times):
        if want and t - want[-1][1] < limit:
            want[-1][1] = t
        else:
            want.append([t, t])
    assert [*zip(spans.starts.tolist(), spans.ends.tolist())] == [*map(tuple, want)]
    since = rnd.choice([None, rnd.randrange(300)])
    known, quiet = since, []
    for t in sorted(times):
        if known is not None and t - known >= limit + 3:
            quiet.append(known)
        known = t if known is None else max(known, t)
    assert spans.quiet(since, limit + 3) == quiet
