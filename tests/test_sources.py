import json

from pyspark.sql import functions as F

from tidelog.model import LOG
from tidelog.operators.metrics import commit_attempt_metrics, observed, stream_metrics
from tidelog.operators import envelope as env
from tidelog.sources import frames as fr, log as lg, registry

from helpers import at, rows


def test_lines_are_numbered_in_file_order_over_splits(spark, tmp_path):
    for name, n in (("a", 500), ("b", 3)):
        (tmp_path / name).write_text("".join(f"line {i}\n" + ("\n" if i % 7 == 0 else "") for i in range(n)) + "tail")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        lines = fr.read_lines(spark, str(tmp_path))
        got = lines.select(F.regexp_extract("file", "([^/]+)$", 1), "frame_id", "value").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    for name, n in (("a", 500), ("b", 3)):
        mine = sorted((r[1], r[2]) for r in got if r[0] == name)
        assert mine == [(i, f"line {i}") for i in range(n)] + [(n, "tail")]


def test_frames_to_events(spark):
    line = {"cursor": {"partition": "0", "offset": "7", "event_type": "e", "cursor_token": "t"}, "events": [{"a": 1}, {"a": 2}]}
    frames = spark.createDataFrame([("s", 0, json.dumps(line)), ("s", 1, "junk")], "stream_id string, frame_id long, value string")
    got = fr.read_events(frames)
    assert rows(got, "frame_id", "pos", "event", "offset") == [(0, 0, '{"a": 1}', 7), (0, 1, '{"a": 2}', 7)]
    decoded = fr.read_events(frames, spark.sql("select 1 as a").schema, ["a"])
    assert rows(decoded, "decoded.a") == [(1,), (2,)]


def some_log(spark):
    data = [("a" if i % 3 else "b", str(i % 4), i // 4, f"e{i}", at(i), at(i), "k", "{}") for i in range(40)]
    return spark.createDataFrame(data, LOG)


def test_stored_log(spark, tmp_path):
    path = str(tmp_path / "log")
    log = some_log(spark)
    lg.write_log(log, path)
    back = lg.read_log(spark, path)
    assert rows(back.select(log.columns)) == rows(log)
    only = lg.read_log(spark, path, ["b"], start="end")
    assert only.count() == 0
    wanted = spark.createDataFrame([("b", "0")], "event_type string, partition string")
    assert lg.read_log(spark, path, ["a", "b"], partitions=wanted).select("partition", "event_type").distinct().count() == 1
    plan = lg.read_log(spark, path, ["b"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_type" in plan


def test_registries(spark):
    data = [(f"s{i}", "app" if i % 2 else "other", ["a", "b"] if i < 4 else ["b"], at(i // 2)) for i in range(6)]
    table = spark.createDataFrame(data, "id string, owning_application string, event_types array<string>, created_at timestamp")
    ids = lambda df: [r["id"] for r in df.collect()]
    assert ids(registry.subscriptions(table)) == ["s4", "s5", "s2", "s3", "s0", "s1"]
    assert ids(registry.subscriptions(table, "a")) == ["s2", "s3", "s0", "s1"]
    assert ids(registry.subscriptions(table, "a", "app", offset=1)) == ["s1"]
    types = spark.createDataFrame([("a",), ("b",)], "name string")
    assert registry.event_types(types).count() == 2 and registry.event_types(types, "a").first()["name"] == "a"


def test_metrics(spark):
    data = [("s", 0, '{"cursor":{"partition":"0","offset":"1","event_type":"e","cursor_token":"t"},"events":[1,2]}', at(0), at(2))]
    frames = spark.createDataFrame(data, "stream_id string, frame_id long, value string, started_at timestamp, completed_at timestamp")
    got = stream_metrics(env.parse_lines(frames)).first()
    assert (got["n_frames"], got["n_events"], got["n_bytes"], got["median_took_us"]) == (1, 2, len(data[0][2]), 2_000_000)
    from pyspark.sql import Observation

    seen = Observation("lines")
    observed(env.parse_lines(frames), seen).write.format("noop").mode("overwrite").save()
    assert seen.get["events_received"] == 2 and seen.get["batches_received"] == 1
    outcomes = spark.createDataFrame([("e", "committed"), ("e", "outdated")], "event_type string, result string")
    assert rows(commit_attempt_metrics(outcomes)) == [("e", 1, 1)]
