import pytest
from pyspark.sql import functions as F, types as T

from tidelog.model import METADATA
from tidelog.operators import publishing as pb
from tidelog.sources import sink

from helpers import rows

PAYLOAD = T.StructType([T.StructField("count", T.LongType())])


def events(spark, *items):
    """Items are (batch_id, pos, event, event_type, version, partition)."""
    df = spark.createDataFrame(list(items), "batch_id long, pos long, event string, et string, version string, p string")
    none = F.lit(None)
    meta = F.struct(
        F.concat(F.lit("e"), F.col("batch_id").cast("string"), F.lit("-"), F.col("pos").cast("string")).alias("eid"),
        F.col("et").alias("event_type"),
        F.current_timestamp().alias("occurred_at"),
        none.cast("timestamp").alias("received_at"),
        F.array().cast("array<string>").alias("parent_eids"),
        F.col("p").alias("partition"),
        F.col("version"),
        none.cast("string").alias("flow_id"),
    ).cast(METADATA)
    return df.select("batch_id", "pos", "event", meta.alias("metadata"))


def judged(spark, *items, write_failed=None, max_bytes=100):
    df = pb.submit(events(spark, *items))
    df = pb.validate(df, "t", PAYLOAD, ["count"], max_bytes)
    df = pb.enrich(df, "t", F.lit("2024-01-01").cast("timestamp"))
    df = pb.partition(df, "user_defined", ["0", "1"])
    return pb.verdict(df, write_failed)


OK = '{"count":1}'


def test_any_early_failure_aborts_the_batch(spark):
    got = judged(
        spark,
        (1, 0, OK, None, None, "0"),
        (1, 1, "{}", None, None, "0"),
        (2, 0, OK, "t", None, "1"),
        (3, 0, OK, "other", None, "0"),
        (4, 0, OK, None, "7", "0"),
        (5, 0, OK, None, None, "9"),
        (6, 0, '{"count":1,"x":"%s"}' % ("y" * 100), None, None, "0"),
    )
    assert rows(got, "batch_id", "pos", "publishing_status", "step", "detail", "code") == [
        (1, 0, "aborted", "none", None, 422),
        (1, 1, "failed", "validating", "missing count", 422),
        (2, 0, "submitted", "publishing", None, 200),
        (3, 0, "failed", "validating", "event type is not the target", 422),
        (4, 0, "failed", "enriching", "may not overwrite version", 422),
        (5, 0, "failed", "partitioning", "unknown partition 9", 422),
        (6, 0, "failed", "validating", "event too large", 422),
    ]
    meta = got.filter("batch_id = 2").first()["metadata"]
    assert (meta["event_type"], meta["version"], meta["partition"]) == ("t", "1.0.0", "1")


def partial(spark):
    return judged(
        spark,
        (1, 0, OK, None, None, "0"),
        (1, 1, OK, None, None, "1"),
        (1, 2, OK, None, None, "1"),
        (2, 0, OK, None, None, "1"),
        (3, 0, "{}", None, None, "0"),
        write_failed=(F.col("batch_id") == 1) & (F.col("metadata.partition") == "1"),
    ).cache()


def test_write_failures_hit_their_partition_only(spark):
    got = partial(spark)
    assert rows(got.filter("batch_id < 3"), "batch_id", "pos", "publishing_status", "code") == [
        (1, 0, "submitted", 207),
        (1, 1, "failed", 207),
        (1, 2, "failed", 207),
        (2, 0, "submitted", 200),
    ]
    stats = {r["batch_id"]: tuple(r)[1:] for r in pb.batch_stats(got).collect()}
    assert stats == {1: (3, 1, 2, 0, 2), 2: (1, 1, 0, 0, 0), 3: (1, 0, 1, 0, 1)}
    assert pb.with_status(got, "failed").count() == 3 and pb.not_submitted(got).count() == 3


def test_retry_sets(spark):
    got = partial(spark)
    sent, answers = got.select("batch_id", "pos", "event"), got.select("batch_id", "pos", "publishing_status", "code")
    assert rows(pb.retry_set(sent, answers), "batch_id", "pos", "error") == [(1, 1, None), (1, 2, None)]
    assert rows(pb.retry_set(sent, answers, "retry_all"), "batch_id", "pos") == [(1, 0), (1, 1), (1, 2)]
    assert pb.retry_set(sent, answers, "abort").count() == 0
    short = answers.filter("not (batch_id = 1 and pos = 2)")
    assert rows(pb.retry_set(sent, short), "batch_id", "pos", "error") == [
        (1, p, "3 events but 2 responses") for p in range(3)
    ]
    silent = answers.filter("batch_id <> 1")
    nameless = answers.withColumn("code", F.when(F.col("batch_id") != 1, F.col("code")))
    for lost in (silent, nameless):
        for strategy in ("retry_all", "retry_not_submitted"):
            assert rows(pb.retry_set(sent, lost, strategy), "batch_id", "pos", "error") == [(1, p, None) for p in range(3)]
    with pytest.raises(ValueError):
        pb.retry_set(sent, answers, "sometimes")


def test_rounds_until_nothing_is_left(spark):
    tries = []

    def attempt(todo, n):
        tries.append(n)
        return pb.verdict(todo, (F.col("pos") >= n) & (F.col("batch_id") == 1)).select("batch_id", "pos", "publishing_status", "code")

    df = pb.submit(events(spark, *[(b, p, OK, None, None, "0") for b in (1, 2) for p in range(3)]))
    out = pb.publish_rounds(df, attempt, max_attempts=9)
    assert rows(pb.batch_stats(out, ["attempt"])) == [(1, 6, 4, 2, 0, 2), (2, 2, 1, 1, 0, 1), (3, 1, 1, 0, 0, 0)]
    assert tries == [1, 2, 3]
    assert out.filter("publishing_status = 'submitted'").select("batch_id", "pos").distinct().count() == 6


def test_no_event_gets_lost(spark):
    """One batch a response short, one never answered, one answered without a code, one turned down."""

    def attempt(todo, n):
        out = pb.verdict(todo, (F.col("pos") == 1) & (F.col("batch_id") <= 2) & F.lit(n == 1))
        out = out.select("batch_id", "pos", "publishing_status", "code", "detail")
        short = (F.col("batch_id") == 1) & (F.col("pos") == 2) & F.lit(n == 1)
        out = out.filter(~short & (F.col("batch_id") != 3))
        return out.withColumn("code", F.when((F.col("batch_id") != 4) | F.lit(n > 1), F.col("code")))

    df = pb.submit(events(spark, *[(b, p, OK, None, None, "0") for b in (1, 2, 3, 4) for p in range(3)]))
    got = rows(pb.publish_accounts(df, attempt, max_attempts=3))
    assert got == [
        *[(1, p, "unpaired", 1 if p < 2 else 0, "3 events but 2 responses") for p in range(3)],
        (2, 0, "submitted", 1, None),
        (2, 1, "submitted", 2, None),
        (2, 2, "submitted", 1, None),
        *[(3, p, "given_up", 0, "no response") for p in range(3)],
        *[(4, p, "submitted", 2, None) for p in range(3)],
    ]


def test_sink_replaces_a_repeated_attempt(spark, tmp_path):
    path = str(tmp_path / "log")
    for _ in range(2):
        answers = sink.publish(partial(spark), path)
    assert answers.count() == 5
    assert rows(sink.published(spark, path), "event_type", "partition", "eid") == [("t", "0", "e1-0"), ("t", "1", "e2-0")]
