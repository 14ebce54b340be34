"""Tables derived from the ``events`` parquet: a log, commits, frames, responses.

They stand for what a broker would hand out, so every operator runs on rows that grow
with the input.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidelog.functions.cursors import empty_as_null
from tidelog.model import ETP
from tidelog.operators.offsets import append_offsets, number_rows
from tidelog.session import scratch_path

N_PARTITIONS = 8
N_STREAMS = 4
FRAME_EVENTS = 10
DATA_TYPES = ("purchase", "signup")
SUBSCRIPTION = "sub-1"
AS_OF = "2024-01-31 00:00:00"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def spread(events: DataFrame) -> DataFrame:
    """Spread a table of fewer splits than cores before row work that is heavy on CPU.

    A table of many splits, as any big one is, is left as it is.
    """
    cores = events.sparkSession.sparkContext.defaultParallelism
    return events if events.rdd.getNumPartitions() >= cores else events.repartition(cores, "event_id")


def to_log_rows(events: DataFrame) -> DataFrame:
    """Event rows in the shape of the log, before they have an offset."""
    payload = F.concat(
        F.lit('{"value":'),
        F.col("value").cast("string"),
        F.lit(',"props":'),
        F.replace(F.col("props"), F.lit(": "), F.lit(":")),
        F.lit("}"),
    )
    return events.select(
        "event_type",
        (F.col("user_id") % N_PARTITIONS).cast("string").alias("partition"),
        F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("eid"),
        F.col("ts").alias("occurred_at"),
        F.col("ts").alias("received_at"),
        F.col("user_id").cast("string").alias("key"),
        payload.alias("payload"),
        "event_id",
    )


@lru_cache(maxsize=64)
def _count(application: str, sf_dir: str) -> int:
    return SparkSession.active().read.parquet(f"{sf_dir}/events.parquet").count()


def n_events(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the events table: an upper bound of what any derived key can hold."""
    return _count(spark.sparkContext.applicationId, sf_dir)


def log(spark: SparkSession, sf_dir: str, segments: int | None = None) -> DataFrame:
    """The event log, with offsets in order of (ts, event_id).

    It is written once for a session and source, as a broker would hold it, instead of
    being derived again wherever a plan reads it.
    """
    rows = to_log_rows(events(spark, sf_dir))
    return _once(
        spark,
        ("log", sf_dir, segments),
        lambda: append_offsets(rows, ["received_at", "event_id"], segments=segments),
    )


_WRITTEN: dict[tuple, tuple[str, T.StructType]] = {}


def _once(spark: SparkSession, key: tuple, make: Callable[[], DataFrame]) -> DataFrame:
    """The table of that name, written to the shared folder when it is first asked for."""
    key = (spark.sparkContext.applicationId, *key)
    if key not in _WRITTEN:
        table = make()
        path = scratch_path(spark, key[1])
        table.write.parquet(path)
        _WRITTEN[key] = path, table.schema
    path, schema = _WRITTEN[key]
    return spark.read.schema(schema).parquet(path)


def stream_of(partition: Column) -> Column:
    return F.concat(F.lit("stream-"), (partition.cast("int") % N_STREAMS).cast("string"))


def commits(log: DataFrame) -> DataFrame:
    """Every tenth event was committed; nothing was for ``view``."""
    return log.filter((F.col("event_id") % 10 == 0) & (F.col("event_type") != "view")).select(
        F.lit(SUBSCRIPTION).alias("subscription_id"),
        stream_of(F.col("partition")).alias("stream_id"),
        *ETP,
        "offset",
        F.col("received_at").alias("committed_at"),
    )


def iso(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def event_json(payload: Column) -> Column:
    """The event as a broker delivers it: data-change for two types, business for the rest."""
    metadata = F.concat(
        F.lit('"metadata":{"eid":"'),
        F.col("eid"),
        F.lit('","event_type":"'),
        F.col("event_type"),
        F.lit('","occurred_at":"'),
        iso("occurred_at"),
        F.lit('","received_at":"'),
        iso("received_at"),
        F.lit('","parent_eids":[],"partition":"'),
        F.col("partition"),
        F.lit('","version":"1.0.0","flow_id":"flow-'),
        F.col("event_id").cast("string"),
        F.lit('"}'),
    )
    op = F.get(F.array(*[F.lit(o) for o in "CUDS"]), (F.col("event_id") % 4).cast("int"))
    change = F.concat(
        F.lit('{"data_type":"'), F.col("event_type"), F.lit('","data_op":"'), op, F.lit('","data":'), payload, F.lit(","), metadata, F.lit("}")
    )
    # The payload's own braces give way to those of the event.
    business = F.concat(F.left(payload, F.length(payload) - 1), F.lit(","), metadata, F.lit("}"))
    return F.when(F.col("event_type").isin(*DATA_TYPES), change).otherwise(business)


def _batch_no() -> Column:
    return F.floor(F.col("offset") / FRAME_EVENTS).cast("long").alias("batch_no")


def batch_heads(log: DataFrame) -> DataFrame:
    """One row per batch line to be: ten events of one partition, in order."""
    return log.groupBy(*ETP, _batch_no()).agg(
        F.max("offset").alias("offset"),
        F.max("received_at").alias("started_at"),
        F.count(F.lit(1)).alias("n_events"),
    )


def batch_texts(log: DataFrame, corrupt: bool = False) -> DataFrame:
    """The events of each batch as JSON texts, in order; at most FRAME_EVENTS of them."""
    payload = F.col("payload")
    if corrupt:
        payload = (
            F.when(F.col("event_id") % 11 == 3, F.lit('{"value":"none","props":{"k":1}}'))
            .when(F.col("event_id") % 13 == 5, F.lit('{"props":{"k":1}}'))
            .otherwise(payload)
        )
    rows = log.withColumn("_payload", payload)
    rows = rows.select(*ETP, "offset", _batch_no(), event_json(F.col("_payload")).alias("event"))
    return rows.groupBy(*ETP, "batch_no").agg(
        F.array_sort(F.collect_list(F.struct("offset", "event"))).alias("events")
    )


def frames(log: DataFrame, corrupt: bool = False, segments: int | None = None) -> DataFrame:
    """Batch lines of four streams.

    Of each partition's batches every tenth is followed by a keep-alive line, every
    seventh carries an info object and every twentieth is followed by a line with an
    empty events array. With ``corrupt`` some lines and events are broken.
    """
    from tidelog.operators.envelope import assemble_line

    texts = batch_texts(log, corrupt)
    heads = batch_heads(log).withColumn(
        "kinds",
        F.filter(
            F.array(
                F.lit("batch"),
                F.when(F.col("batch_no") % 10 == 9, F.lit("keep_alive")),
                F.when(F.col("batch_no") % 20 == 19, F.lit("none")),
            ),
            lambda k: k.isNotNull(),
        ),
    )
    heads = heads.select(
        stream_of(F.col("partition")).alias("stream_id"), "*", F.posexplode("kinds").alias("line_no", "kind")
    ).withColumn("started_at", F.timestamp_micros(F.unix_micros("started_at") + F.col("line_no") * 1_000_000))
    order = ["started_at", "event_type", "partition", "batch_no", "line_no"]
    # Lines are numbered without their texts, which stay where their partition is.
    heads = number_rows(heads, ["stream_id"], order, "frame_id", segments=segments)
    rows = heads.join(texts, [*ETP, "batch_no"])

    token = F.concat(F.lit("token-"), F.col("offset").cast("string"))
    partition = F.col("partition")
    if corrupt:
        token = F.when(F.col("batch_no") % 8 != 5, token)
        partition = F.when(F.col("batch_no") % 8 == 6, F.lit("")).otherwise(partition)
    texts = F.transform("events", lambda e: e["event"])
    texts = F.when(F.col("kind") == "batch", texts).when(F.col("kind") == "none", F.array().cast("array<string>"))
    info = F.when(
        (F.col("kind") == "batch") & (F.col("batch_no") % 7 == 6),
        F.concat(F.lit('{"debug":"batch '), F.col("batch_no").cast("string"), F.lit('"}')),
    )
    value = assemble_line(partition, F.col("offset").cast("string"), F.col("event_type"), token, texts, info)
    if corrupt:
        value = F.when(F.col("batch_no") % 8 == 7, F.left(value, F.lit(60))).otherwise(value)
    n_events = F.when(F.col("kind") == "batch", F.col("n_events")).otherwise(0)
    lines = rows.select(
        "stream_id",
        "frame_id",
        value.alias("value"),
        "started_at",
        F.timestamp_micros(F.unix_micros("started_at") + 2000 + n_events * 1000).alias("completed_at"),
    )
    return lines


def lines(spark: SparkSession, sf_dir: str, corrupt: bool = False) -> DataFrame:
    """The frames of the whole log, written once."""
    rows = log(spark, sf_dir)
    return _once(spark, ("frames", sf_dir, corrupt), lambda: frames(rows, corrupt))


def stats_rows(log: DataFrame, commits: DataFrame) -> DataFrame:
    """Per partition statistics with the stream that reads it ('' for odd, unread ones)."""
    from tidelog.operators.offsets import latest_commits, partition_stats

    stream = F.when(F.col("partition").cast("int") % 3 == 2, F.lit("")).otherwise(stream_of(F.col("partition")))
    return partition_stats(log, latest_commits(commits)).withColumn("stream_id", empty_as_null(stream))
