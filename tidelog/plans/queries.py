"""The registered queries: every operator run over whole tables derived from ``events``.

Each function takes (spark, sf_dir). Times come out as microseconds (``…_us``).
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidelog.functions import cursors as cur
from tidelog.functions.events import metadata_to_publish, new_metadata
from tidelog.functions.hashing import key_hash, unsigned_text
from tidelog.model import ETP, METADATA, business_event, data_change_event
from tidelog.operators import commits as cm
from tidelog.operators import envelope as env
from tidelog.operators import handlers as hd
from tidelog.operators import liveness, metrics, offsets as of, partitioning as pt, publishing as pb
from tidelog.operators import sequence as sq
from tidelog.plans import tables as tb
from tidelog.session import scratch_path, stored
from tidelog.sources import frames as fr, log as lg, registry, sink
from tidelog.streaming import consume as sc, state as ss

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PAYLOAD = T.StructType(
    [
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StructType([T.StructField("k", T.LongType())])),
    ]
)
PARTITIONS = [str(i) for i in range(tb.N_PARTITIONS)]
TWELVE = [str(i) for i in range(12)]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _lines(spark: SparkSession, sf_dir: str, corrupt: bool = False) -> DataFrame:
    """Batch lines over the whole log, written once. Frames number fewer than events."""
    return tb.lines(spark, sf_dir, corrupt)


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return env.valid_lines(env.parse_lines(_lines(spark, sf_dir)))


def _us(column: str) -> Column:
    return F.unix_micros(column)


# --- offsets, lag, statistics --------------------------------------------------------


@query
def unconsumed_per_event_type(spark, sf_dir):
    log = tb.log(spark, sf_dir)
    return of.unconsumed(tb.stats_rows(log, tb.commits(log)))


@query
def partition_info(spark, sf_dir):
    return of.partition_info(tb.log(spark, sf_dir))


@query
def partition_stats(spark, sf_dir):
    log = tb.log(spark, sf_dir)
    return tb.stats_rows(log, tb.commits(log)).select(*ETP, "oldest", "newest", "committed", "unconsumed", "stream_id")


@query
def unconsumed_of_stream(spark, sf_dir):
    log = tb.log(spark, sf_dir)
    return of.unconsumed_of_stream(tb.stats_rows(log, tb.commits(log)), "stream-1")


@query
def unconsumed_of_subscription(spark, sf_dir):
    log = tb.log(spark, sf_dir)
    stats = tb.stats_rows(log, tb.commits(log)).withColumn("subscription_id", F.lit(tb.SUBSCRIPTION))
    return of.unconsumed(stats, ["subscription_id"])


@query
def subscription_stats_report(spark, sf_dir):
    log = tb.log(spark, sf_dir)
    return of.stats_report(tb.stats_rows(log, tb.commits(log)))


@query
def cursor_lag(spark, sf_dir):
    log = tb.log(spark, sf_dir)
    cursors = of.latest_commits(tb.commits(log)).withColumnRenamed("committed", "offset")
    return of.cursor_lag(log, cursors)


@query
def cursor_lag_after_compaction(spark, sf_dir):
    log = tb.log(spark, sf_dir)
    cursors = tb.commits(log).select(*ETP, "offset")
    return of.cursor_lag(
        of.compacted(log.select(*ETP, "offset", "key")), cursors, dense=False
    )


@query
def cursor_distance(spark, sf_dir):
    log = tb.log(spark, sf_dir)
    stats = tb.stats_rows(log, tb.commits(log))
    ends = F.explode(
        F.array(
            F.struct(F.lit("committed_to_newest").alias("pair"), F.col("committed").alias("i"), F.col("newest").alias("f"), F.col("partition").alias("fp")),
            F.struct(F.lit("newest_to_committed").alias("pair"), F.col("newest").alias("i"), F.col("committed").alias("f"), F.col("partition").alias("fp")),
            F.struct(F.lit("other_partition").alias("pair"), F.col("committed").alias("i"), F.col("newest").alias("f"), F.lit("other").alias("fp")),
        )
    ).alias("e")
    pairs = stats.filter(F.col("committed").isNotNull()).select(*ETP, ends).select(
        F.col("e.pair").alias("pair"),
        F.col("event_type").alias("initial_event_type"),
        F.col("partition").alias("initial_partition"),
        F.col("e.i").alias("initial_offset"),
        F.col("event_type").alias("final_event_type"),
        F.col("e.fp").alias("final_partition"),
        F.col("e.f").alias("final_offset"),
    )
    return of.cursor_distance(pairs)


@query
def time_lag(spark, sf_dir):
    log = tb.log(spark, sf_dir)
    lag = of.time_lag(log, of.latest_commits(tb.commits(log)), tb.as_of(), tb.n_events(spark, sf_dir))
    return lag.select(*ETP, _us("oldest_pending_at").alias("oldest_pending_us"), "lag_seconds")


@query
def subscribed_events(spark, sf_dir):
    log = tb.log(spark, sf_dir)
    odd = of.partition_info(log).filter(F.col("partition").cast("int") % 2 == 1)
    cursors = of.latest_commits(tb.commits(log)).select(*ETP, F.floor(F.col("committed") / 2).cast("long").alias("offset"))
    rows = lg.subscribe(log, ["click", "view"], odd, "cursors", cursors, tb.n_events(spark, sf_dir))
    return rows.select(*ETP, "offset", "eid")


@query
def events_by_start_position(spark, sf_dir):
    log = tb.log(spark, sf_dir)
    cursors = of.latest_commits(tb.commits(log)).withColumnRenamed("committed", "offset")
    parts = [
        of.read_from(log, start, cursors, tb.n_events(spark, sf_dir)).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events")).select(F.lit(start).alias("start"), "*")
        for start in ("begin", "end", "cursors")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def retained_events(spark, sf_dir):
    return of.retained(tb.log(spark, sf_dir), 7 * 86_400_000, tb.as_of()).select(*ETP, "offset", "eid")


@query
def compacted_log(spark, sf_dir):
    """Every seventh event has no key, and views are of the category that isn't compacted."""
    key = F.when(F.col("event_id") % 7 != 0, F.col("key"))
    log = tb.log(spark, sf_dir).select(*ETP, key.alias("key"), "offset", "eid")
    return of.compacted(log, leave=F.col("event_type") == "view")


@query
def compacted_increment(spark, sf_dir):
    """A log compacted up to some offset, then with what came since."""
    log = tb.log(spark, sf_dir).select(*ETP, "key", "offset", "eid")
    old = F.col("offset") < 60
    return of.compacted(log.filter(~old), base=of.compacted(log.filter(old)))


@query
def first_receptions(spark, sf_dir):
    log = tb.log(spark, sf_dir).select("eid", *ETP, "offset", "received_at", "event_id")
    again = log.filter(F.col("event_id") % 9 == 0).withColumn(
        "received_at", F.timestamp_micros(_us("received_at") + 5_000_000)
    )
    unique = of.first_reception(log.unionByName(again))
    return unique.select("eid", *ETP, "offset", _us("received_at").alias("received_us"))


@query
def limited_stream(spark, sf_dir):
    """The stream limit is the feature here: the first 1000 events of all partitions."""
    return of.stream_limit(tb.log(spark, sf_dir), 1000).select(*ETP, "offset")


@query
def cursor_forms(spark, sf_dir):
    """Cursors as JSON, flat and nested, read back and projected."""
    rows = tb.log(spark, sf_dir).select(*ETP, "offset")
    text = cur.offset_text(F.when(F.col("offset") % 3 == 0, F.lit(-1).cast("long")).otherwise(F.col("offset")))
    flat = F.to_json(F.struct(F.col("event_type"), F.col("partition"), text.alias("offset")))
    nested = F.to_json(F.struct(F.col("event_type"), F.struct(F.col("partition"), text.alias("offset")).alias("cursor")))
    read = rows.select("*", cur.read_cursor(F.when(F.col("offset") % 2 == 0, flat).otherwise(nested)).alias("c"))
    return read.select(
        *ETP,
        "offset",
        F.col("c.event_type").alias("read_event_type"),
        cur.to_partition(F.col("c"))["partition"].alias("read_partition"),
        cur.offset_value(cur.without_token(F.col("c"))["offset"]).alias("read_offset"),
        cur.to_begin(F.col("c"))["offset"].alias("begin_offset"),
    )


# --- batch lines ----------------------------------------------------------------------


@query
def parsed_lines(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "stream_id", "frame_id", *ETP, "offset", "cursor_token", "n_events", "kind", "has_info", "info"
    )


@query
def line_kinds(spark, sf_dir):
    return env.parse_lines(_lines(spark, sf_dir)).groupBy("stream_id", "kind", "has_info").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("n_events").cast("long").alias("n_events")
    )


@query
def lines_from_text_files(spark, sf_dir):
    """Lines written as newline-delimited files and read back, with their numbers in the stream."""
    path = scratch_path(spark, "lines")
    fr.write_lines(_lines(spark, sf_dir), path)
    lines = env.valid_lines(env.parse_lines(fr.read_lines(spark, path)))
    return lines.select("stream_id", "frame_id", *ETP, "offset", F.col("n_events").cast("long").alias("n_events"))


@query
def quarantined_lines(spark, sf_dir):
    parsed = env.parse_lines(_lines(spark, sf_dir, corrupt=True))
    return env.quarantined_lines(parsed).select("stream_id", "frame_id", "problem")


@query
def exploded_events(spark, sf_dir):
    events = env.explode_events(env.event_batches(_parsed(spark, sf_dir)))
    return events.select(
        "stream_id", "frame_id", "pos", F.get_json_object("event", "$.metadata.eid").alias("eid"), *ETP
    )


def _decoded(spark, sf_dir, change: bool, corrupt: bool = False) -> DataFrame:
    lines = env.valid_lines(env.parse_lines(_lines(spark, sf_dir, corrupt)))
    events = env.explode_events(env.event_batches(lines))
    mine = F.col("event_type").isin(*tb.DATA_TYPES)
    if change:
        return env.decode_events(events.filter(mine), data_change_event(PAYLOAD), ["data.value", "metadata.eid"])
    return env.decode_events(events.filter(~mine), business_event(PAYLOAD), ["value", "metadata.eid"])


@query
def business_events(spark, sf_dir):
    flat = env.flatten_business(_decoded(spark, sf_dir, change=False))
    return flat.select(
        F.col("meta_eid").alias("eid"),
        "value",
        F.col("props.k").alias("k"),
        F.col("meta_event_type").alias("event_type"),
        F.col("meta_partition").alias("partition"),
        _us("meta_occurred_at").alias("occurred_us"),
        F.col("meta_version").alias("version"),
        F.col("meta_flow_id").alias("flow_id"),
        F.size("meta_parent_eids").cast("long").alias("n_parents"),
    )


@query
def data_change_events(spark, sf_dir):
    flat = env.flatten_data_change(_decoded(spark, sf_dir, change=True))
    return flat.select(
        F.col("meta_eid").alias("eid"), "value", F.col("props.k").alias("k"), "data_type", "data_op", "data_op_name"
    )


@query
def decode_errors(spark, sf_dir):
    """Events that cannot be decoded, each with its raw text."""
    both = _decoded(spark, sf_dir, False, True).drop("decoded").unionByName(_decoded(spark, sf_dir, True, True).drop("decoded"))
    bad = both.filter(F.col("error").isNotNull())
    return bad.select("stream_id", "frame_id", "pos", "error", F.get_json_object("event", "$.metadata.eid").alias("eid"))


@query
def decode_failures_per_batch(spark, sf_dir):
    both = _decoded(spark, sf_dir, False, True).drop("decoded").unionByName(_decoded(spark, sf_dir, True, True).drop("decoded"))
    return env.decode_failures(both, ["stream_id", "frame_id"])


@query
def line_bytes(spark, sf_dir):
    return env.byte_stats(_parsed(spark, sf_dir)).select(
        "stream_id",
        "frame_id",
        F.col("n_bytes").cast("long").alias("n_bytes"),
        F.col("n_events_bytes").cast("long").alias("n_events_bytes"),
    )


@query
def assembled_bodies(spark, sf_dir):
    log = tb.log(spark, sf_dir).withColumn("event", tb.event_json(F.col("payload")))
    rows = log.withColumn("batch_no", F.floor(F.col("offset") / 50).cast("long"))
    bodies = env.assemble_events(rows, [*ETP, "batch_no"], "offset")
    return bodies.select(
        *ETP, "batch_no", "n_events", F.octet_length("body").cast("long").alias("n_bytes"), F.md5("body").alias("digest")
    )


@query
def republished_metadata(spark, sf_dir):
    meta = metadata_to_publish(F.col("decoded.metadata")).alias("m")
    both = [_decoded(spark, sf_dir, change=change).select(meta) for change in (False, True)]
    return both[0].unionByName(both[1]).select(
        F.col("m.eid").alias("eid"),
        F.col("m.event_type").alias("event_type"),
        _us("m.occurred_at").alias("occurred_us"),
        F.size("m.parent_eids").cast("long").alias("n_parents"),
        F.col("m.partition").alias("partition"),
        F.col("m.flow_id").alias("flow_id"),
    )


@query
def new_event_metadata(spark, sf_dir):
    rows = tb.to_log_rows(tb.events(spark, sf_dir))
    return rows.select(new_metadata(F.col("eid"), F.col("occurred_at")).alias("m")).select(
        F.col("m.eid").alias("eid"),
        _us("m.occurred_at").alias("occurred_us"),
        F.size("m.parent_eids").cast("long").alias("n_parents"),
        F.col("m.event_type").alias("event_type"),
    )


# --- partition assignment -------------------------------------------------------------


@query
def key_hashes(spark, sf_dir):
    rows = tb.spread(tb.events(spark, sf_dir))
    key = F.concat(F.lit("user-"), F.col("user_id").cast("string"), F.lit("-é"))
    return rows.select("event_id", key.alias("key"), unsigned_text(key_hash(key)).alias("hash"))


@query
def partitions_by_key(spark, sf_dir):
    rows = tb.to_log_rows(tb.spread(tb.events(spark, sf_dir)))
    none = F.lit(None).cast("string")
    events = rows.select("event_id", "key", F.struct(F.col("eid"), none.alias("partition")).alias("metadata"))
    assigned = pt.assign_partitions(events, F.col("key"), TWELVE)
    return assigned.select("event_id", F.col("metadata.partition").alias("partition"))


@query
def partitions_by_compound_key(spark, sf_dir):
    rows = tb.to_log_rows(tb.spread(tb.events(spark, sf_dir))).drop("partition")
    assigned = pt.assign_by_strategy(rows, "hash", PARTITIONS, key_fields=["event_type", "key"])
    return assigned.select("event_id", "assigned")


@query
def random_partition_spread(spark, sf_dir):
    """The random strategy, with some events that have no eid."""
    rows = tb.to_log_rows(tb.spread(tb.events(spark, sf_dir)))
    rows = rows.withColumn("eid", F.when(F.col("event_id") % 50 != 0, F.col("eid")))
    return pt.assign_by_strategy(rows, "random", PARTITIONS).select("event_id", "assigned", "rejection")


@query
def partitions_by_own_hash(spark, sf_dir):
    """A hash function of the caller's own."""
    rows = tb.to_log_rows(tb.spread(tb.events(spark, sf_dir)))
    none = F.lit(None).cast("string")
    events = rows.select("event_id", "key", F.struct(F.col("eid"), none.alias("partition")).alias("metadata"))
    own = lambda key: F.length(key).cast("long") * 31 + F.ascii(key) + F.ascii(F.right(key, F.lit(1)))
    assigned = pt.assign_partitions(events, F.col("key"), TWELVE, hasher=own)
    return assigned.select("event_id", F.col("metadata.partition").alias("partition"))


@query
def user_defined_partitions(spark, sf_dir):
    events = tb.events(spark, sf_dir)
    given = F.when(F.col("event_id") % 50 == 0, F.lit(None)).otherwise((F.col("user_id") % 10).cast("string"))
    rows = events.select("event_id", given.alias("partition"))
    return pt.assign_by_strategy(rows, "user_defined", PARTITIONS).select("event_id", "assigned", "rejection")


@query
def sorted_partition_ids(spark, sf_dir):
    users = tb.events(spark, sf_dir).select("user_id", "event_type").distinct()
    numeric = users.select((F.col("user_id") % 30).cast("string").alias("partition"))
    mixed = users.select(F.concat(F.lit("p"), (F.col("user_id") % 30).cast("string")).alias("partition"))
    return (
        pt.sorted_partitions(numeric)
        .withColumn("ids", F.lit("numbers"))
        .unionByName(pt.sorted_partitions(mixed).withColumn("ids", F.lit("texts")))
        .select("ids", F.col("place").cast("long").alias("place"), "partition")
    )


@query
def partition_counts(spark, sf_dir):
    parallelism = tb.events(spark, sf_dir).groupBy("event_type").agg(
        (F.count(F.lit(1)) % 7 + 1).alias("read_parallelism"), (F.max("user_id") % 5 + 1).alias("write_parallelism")
    )
    return parallelism.withColumn("n_partitions", pt.partition_count(F.col("read_parallelism"), F.col("write_parallelism")))


# --- sequences ------------------------------------------------------------------------


@query
def frame_gaps(spark, sf_dir):
    frames = _lines(spark, sf_dir).select("stream_id", "frame_id", "started_at")
    return sq.frame_gaps(frames).select("stream_id", "frame_id", "gap_us", "warning")


@query
def batch_gaps(spark, sf_dir):
    batches = env.event_batches(_parsed(spark, sf_dir)).select("stream_id", "frame_id", "started_at")
    return sq.frame_gaps(batches).select("stream_id", "frame_id", "gap_us")


def _deltas(spark, sf_dir) -> DataFrame:
    """Dispatched, processed and (nine batches of ten) committed: signed changes."""
    b = env.byte_stats(env.event_batches(_parsed(spark, sf_dir)))
    zero = F.lit(0).cast("long")
    n, size = F.col("n_events").cast("long"), F.col("n_bytes").cast("long")

    def change(at: Column, step: int, sign: int, flight: bool, open_: bool) -> Column:
        return F.struct(
            at.alias("at"),
            (F.col("frame_id") * 3 + step).alias("seq"),
            (F.lit(sign).cast("long") if flight else zero).alias("batches_in_flight"),
            (n * sign if flight else zero).alias("events_in_flight"),
            (size * sign if flight else zero).alias("bytes_in_flight"),
            (F.lit(sign).cast("long") if open_ else zero).alias("uncommitted_batches"),
            (n * sign if open_ else zero).alias("uncommitted_events"),
        )

    late = F.timestamp_micros(_us("completed_at") + 5_000_000)
    changes = F.array(
        change(F.col("started_at"), 0, 1, True, True),
        change(F.col("completed_at"), 1, -1, True, False),
        F.when(F.col("frame_id") % 10 != 0, change(late, 2, -1, False, True)),
    )
    return b.select("stream_id", F.explode(F.array_compact(changes)).alias("c")).select("stream_id", "c.*")


@query
def in_flight_totals(spark, sf_dir):
    totals = sq.in_flight(_deltas(spark, sf_dir))
    return totals.withColumn("at_us", _us("at")).drop("at")


@query
def left_over_totals(spark, sf_dir):
    return sq.left_over(_deltas(spark, sf_dir))


@query
def partition_activity_intervals(spark, sf_dir):
    return sq.activity_intervals(tb.log(spark, sf_dir), 7200, tb.as_of())


@query
def frame_order_per_assignment(spark, sf_dir):
    """Frames of an assignment that arrive after one with a higher id."""
    late = F.when(F.col("frame_id") % 17 == 0, 400_000_000_000).otherwise(0)
    b = env.event_batches(_parsed(spark, sf_dir)).select("stream_id", *ETP, "frame_id", (_us("completed_at") + late).alias("_at"))
    arrived = of.number_rows(b, ["stream_id"], ["_at", "frame_id"], "arrival")
    return sq.frame_order(arrived, ["stream_id", *ETP]).select(
        "stream_id", *ETP, "arrival", "frame_id", "previous_frame_id", "increasing"
    )


@query
def batches_by_count(spark, sf_dir):
    return sq.batches_by_count(tb.log(spark, sf_dir), 7, n_rows=tb.n_events(spark, sf_dir)).groupBy(*ETP, "batch_no").agg(
        F.count(F.lit(1)).alias("n_events"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )


@query
def batches_by_count_after_compaction(spark, sf_dir):
    log = of.compacted(tb.log(spark, sf_dir).select(*ETP, "key", "offset"))
    return sq.batches_by_count(log, 7, dense=False, n_rows=tb.n_events(spark, sf_dir)).select(*ETP, "offset", "batch_no")


@query
def batches_by_timespan(spark, sf_dir):
    return sq.batches_by_timespan(tb.log(spark, sf_dir), 36_000).select(*ETP, "offset", "batch_no")


@query
def ordering_key_inversions(spark, sf_dir):
    log = tb.log(spark, sf_dir).withColumn("k", F.get_json_object("payload", "$.props.k").cast("long"))
    return sq.order_inversions(log, ["k", "key"]).select(*ETP, "offset", "key_place", "inverted")


# --- commits --------------------------------------------------------------------------


def _cursors(spark, sf_dir) -> DataFrame:
    """The cursors of the handled batches of every stream in order of arrival."""
    b = env.event_batches(_parsed(spark, sf_dir))
    return b.select(
        "stream_id",
        *ETP,
        "offset",
        "frame_id",
        F.col("frame_id").alias("seq"),
        "started_at",
        F.col("completed_at").alias("arrived_at"),
        "n_events",
    )


def _cut(spark, sf_dir, strategy: cm.CommitStrategy, commit_timeout_secs: int = 60) -> DataFrame:
    return cm.cut_commits(_cursors(spark, sf_dir), strategy, commit_timeout_secs=commit_timeout_secs)


# Streams are quiet for hours in the data, so limits are in hours as well.
AFTER = cm.CommitStrategy("after", seconds=20_000, cursors=6, events=45)
LATEST = cm.CommitStrategy("latest_possible")
CUT_TIMEOUT_SECS = 30_001


@query
def coalesced_cursors(spark, sf_dir):
    last = cm.coalesce_cursors(_cursors(spark, sf_dir), ["stream_id"])
    return last.select(
        "stream_id", *ETP, "offset", "first_frame_id", "last_frame_id", _us("first_started_at").alias("first_us"), "n_batches", "n_events"
    )


@query
def commits_immediately(spark, sf_dir):
    cut = _cut(spark, sf_dir, cm.CommitStrategy("immediately"))
    return cut.select("stream_id", "seq", "commit_no", "trigger", "triggered_us")


@query
def commits_after_limits(spark, sf_dir):
    cut = _cut(spark, sf_dir, AFTER, CUT_TIMEOUT_SECS)
    return cut.select("stream_id", "seq", (F.col("commit_no")).alias("commit_no"), "trigger", "triggered_us")


@query
def commits_latest_possible(spark, sf_dir):
    cut = _cut(spark, sf_dir, LATEST, CUT_TIMEOUT_SECS)
    return cut.select("stream_id", "seq", "commit_no", "trigger", "triggered_us")


@query
def commit_entries_with_ages(spark, sf_dir):
    cut = _cut(spark, sf_dir, AFTER, CUT_TIMEOUT_SECS)
    entries = cm.commit_table(cut)
    attempted = F.coalesce(F.timestamp_micros("triggered_us"), tb.as_of())
    aged = cm.cursor_ages(entries, attempted, CUT_TIMEOUT_SECS)
    return aged.select(
        "stream_id", "commit_no", *ETP, "offset", "first_frame_id", "n_batches", "n_events", "first_age_us", "last_age_us", "warning"
    )


@query
def commit_trigger_metrics(spark, sf_dir):
    return cm.commit_metrics(_cut(spark, sf_dir, AFTER, CUT_TIMEOUT_SECS))


def _attempts(spark, sf_dir) -> DataFrame:
    """Commit attempts, some of them a day late."""
    commits = tb.commits(tb.log(spark, sf_dir))
    late = F.when(F.col("offset") % 4 == 1, 86_400_000_000).otherwise(0)
    return commits.withColumn("at_us", _us("committed_at") + late)


def _outcomes(spark, sf_dir) -> DataFrame:
    return cm.commit_outcomes(_attempts(spark, sf_dir), ["at_us", "offset"])


@query
def commit_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir).select(*ETP, "offset", "at_us", "result")


@query
def outdated_cursors(spark, sf_dir):
    return cm.with_result(_outcomes(spark, sf_dir), "outdated").select(*ETP, "offset")


@query
def all_committed_per_event_type(spark, sf_dir):
    return cm.all_committed(_outcomes(spark, sf_dir), ["event_type"])


@query
def commit_attempt_metrics(spark, sf_dir):
    return metrics.commit_attempt_metrics(_outcomes(spark, sf_dir))


def _commit_calls(spark, sf_dir) -> DataFrame:
    """What a committer logs: every seventh cursor fails first and is tried again, late ones are outdated."""
    calls = _attempts(spark, sf_dir).select(
        F.timestamp_micros("at_us").alias("at"),
        F.lit(1).alias("n_cursors"),
        ((F.col("offset") * 7919 + F.col("partition").cast("long") * 131) % 5003 + 900).alias("took_us"),
        F.when(F.col("offset") % 4 == 1, F.lit("not_committed")).otherwise(F.lit("committed")).alias("last"),
        (F.col("offset") % 7 == 0).alias("again"),
    )
    outcomes = F.when(F.col("again"), F.array(F.lit("failed"), F.col("last"))).otherwise(F.array("last"))
    return calls.withColumn("outcome", F.explode(outcomes)).drop("last", "again")


@query
def commit_attempt_times(spark, sf_dir):
    """Times of attempts by outcome, merged from a sketch per day, and whether the quantiles hold within 2 % and two rows."""
    calls = stored(_commit_calls(spark, sf_dir), "calls")
    found = metrics.with_quantiles(metrics.merged_windows(metrics.attempt_windows(calls)), {"median": 0.5, "p95": 0.95})
    below = calls.join(F.broadcast(found.select("outcome", "median", "p95")), "outcome").groupBy("outcome").agg(
        *[(F.abs(F.avg((F.col("took_us") <= F.col(c)).cast("int")) - q) <= 0.02 + 2 / F.count("*")).alias(f"{c}_holds") for c, q in (("median", 0.5), ("p95", 0.95))]
    )
    return found.drop("median", "p95").join(below, "outcome")


@query
def commits_after_reset(spark, sf_dir):
    """Even partitions were set back to the beginning at mid-month, views to a given offset.

    No partition of views was ever committed.
    """
    log = tb.log(spark, sf_dir)
    commits = tb.commits(log).withColumn("reset", F.lit(False))
    at = F.lit("2024-01-15 00:00:00").cast("timestamp")
    resets = cm.reset_cursors(commits.filter(F.col("partition").cast("int") % 2 == 0), at)
    given = of.partition_info(log.filter(F.col("event_type") == "view")).select(*ETP, (F.col("newest") - 3).alias("offset"))
    resets = resets.unionByName(cm.reset_cursors(commits, at, given, tb.SUBSCRIPTION))
    return cm.effective_commits(commits.unionByName(resets), tb.n_events(spark, sf_dir))


# --- publishing -----------------------------------------------------------------------


def _to_publish(spark, sf_dir) -> DataFrame:
    """Batches of 50 events, a few of which break each rule."""
    e = tb.to_log_rows(tb.spread(tb.events(spark, sf_dir)))
    id_ = F.col("event_id")
    none = F.lit(None).cast("string")
    text = F.when(id_ % 1009 == 7, F.lit('{"props":{"k":1}}')).when(id_ % 1013 == 11, F.lit('{"value":"x"}')).otherwise(F.col("payload"))
    meta = F.struct(
        F.col("eid"),
        F.when(id_ % 499 == 3, F.lit("other")).when(id_ % 2 == 0, F.col("event_type")).alias("event_type"),
        F.col("occurred_at"),
        F.lit(None).cast("timestamp").alias("received_at"),
        F.array().cast("array<string>").alias("parent_eids"),
        F.when(id_ % 503 == 1, F.lit("99")).otherwise(F.col("partition")).alias("partition"),
        F.when(id_ % 997 == 5, F.lit("9.9.9")).otherwise(none).alias("version"),
        none.alias("flow_id"),
    ).cast(METADATA)
    return e.select(
        F.floor(id_ / 50).cast("long").alias("batch_id"),
        (id_ % 50).alias("pos"),
        "event_id",
        F.col("event_type").alias("target"),
        text.alias("event"),
        meta.alias("metadata"),
    )


def _judged_before_write(spark, sf_dir) -> DataFrame:
    rows = pb.submit(_to_publish(spark, sf_dir))
    rows = pb.validate(rows, F.col("target"), PAYLOAD, ["value"], max_bytes=10_000)
    rows = pb.enrich(rows, F.col("target"), tb.as_of())
    return pb.partition(rows, "user_defined", PARTITIONS)


def _lost(n: int = 1) -> Column:
    """Partition 3 cannot be written in every fifth batch; later attempts lose fewer."""
    return (F.col("metadata.partition") == "3") & (F.col("batch_id") % 5 == 0) & (F.col("event_id") % (1 << (n - 1)) == 0)


def _judged(spark, sf_dir) -> DataFrame:
    return pb.verdict(_judged_before_write(spark, sf_dir), _lost())


@query
def publish_verdicts(spark, sf_dir):
    return _judged(spark, sf_dir).select(
        "batch_id", "pos", F.col("metadata.eid").alias("eid"), "publishing_status", "step", "detail", F.col("code").cast("long").alias("code")
    )


@query
def publish_stats(spark, sf_dir):
    return pb.batch_stats(_judged(spark, sf_dir))


@query
def not_submitted_items(spark, sf_dir):
    return pb.not_submitted(_judged(spark, sf_dir)).select("batch_id", "pos", "publishing_status")


def _answers(judged: DataFrame) -> DataFrame:
    return judged.select("batch_id", "pos", "publishing_status", "code")


@query
def publish_retry_set(spark, sf_dir):
    """Every seventh batch came back one response short."""
    judged = stored(_judged(spark, sf_dir), "judged")
    answers = _answers(judged).filter(~((F.col("batch_id") % 7 == 0) & (F.col("pos") == 49)))
    again = pb.retry_set(judged.select("batch_id", "pos", "event"), answers)
    return again.select("batch_id", "pos", "error")


@query
def publish_retry_all(spark, sf_dir):
    judged = stored(_judged(spark, sf_dir), "judged")
    return pb.retry_set(judged.select("batch_id", "pos"), _answers(judged), "retry_all").select("batch_id", "pos")


@query
def publish_attempts(spark, sf_dir):
    def attempt(todo: DataFrame, n: int) -> DataFrame:
        return pb.verdict(todo, _lost(n)).select("batch_id", "pos", "publishing_status", "code")

    responses = pb.publish_rounds(_judged_before_write(spark, sf_dir), attempt, max_attempts=3)
    stats = pb.batch_stats(responses, ["attempt"])
    return stats.withColumn("attempt", F.col("attempt").cast("long"))


@query
def publish_accounts(spark, sf_dir):
    """What became of every event although answers were lost.

    At the first attempt every seventh batch gets one response too few, some batches get
    none and some get responses without a code.
    """

    def attempt(todo: DataFrame, n: int) -> DataFrame:
        answers = pb.verdict(todo, _lost(n)).select("batch_id", "pos", "publishing_status", "code", "detail")
        if n > 1:
            return answers
        heard = ~((F.col("batch_id") % 7 == 0) & (F.col("pos") == 49)) & (F.col("batch_id") % 11 != 5)
        return answers.filter(heard).withColumn("code", F.when(F.col("batch_id") % 13 != 3, F.col("code")))

    accounts = pb.publish_accounts(_judged_before_write(spark, sf_dir), attempt, max_attempts=3)
    return accounts.withColumn("attempts", F.col("attempts").cast("long"))


@query
def published_log(spark, sf_dir):
    path = scratch_path(spark, "published")
    sink.publish(_judged(spark, sf_dir), path)
    return sink.published(spark, path).groupBy(*ETP).agg(
        F.count(F.lit(1)).alias("n_events"), F.max(_us("received_at")).alias("received_us"), F.max("eid").alias("last_eid")
    )


# --- handlers -------------------------------------------------------------------------


def _sample_handler(events: list[str], meta: hd.BatchMeta):
    if meta.frame_id % 97 == 50:
        return hd.ABORT_STREAM, "asked to"
    if meta.frame_id % 211 == 100:
        return hd.SHUT_DOWN, "asked to"
    return hd.COMMIT if len(events) == 10 else hd.DO_NOT_COMMIT


def _handled(spark, sf_dir) -> DataFrame:
    return hd.dispatch(_parsed(spark, sf_dir), _sample_handler, ordered=False)


@query
def handler_outcomes(spark, sf_dir):
    """Calls in order: none in a scope after a stop."""
    return hd.settle(hd.dispatch(_parsed(spark, sf_dir), _sample_handler), n_rows=tb.n_events(spark, sf_dir)).select(
        "stream_id", *ETP, "frame_id", "n_events", "action", "settled"
    )


@query
def handler_outcomes_by_event_type(spark, sf_dir):
    handlers = {t: _sample_handler for t in ("click", "error", "purchase", "signup", "view")}
    results = hd.dispatch(_parsed(spark, sf_dir), handlers, "event_type_par")
    return hd.settle(results, "event_type_par", tb.n_events(spark, sf_dir)).groupBy("stream_id", "event_type", "settled").agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum("n_events").cast("long").alias("n_events")
    )


@query
def handled_cursors(spark, sf_dir):
    last = cm.coalesce_cursors(hd.cursors_to_commit(hd.settle(_handled(spark, sf_dir), n_rows=tb.n_events(spark, sf_dir))), ["stream_id"])
    return last.select("stream_id", *ETP, "offset", "n_batches", "n_events")


@query
def events_handled(spark, sf_dir):
    return hd.events_handled(_handled(spark, sf_dir))


@query
def processing_metrics(spark, sf_dir):
    """The handlers get decoded events; decoding takes time, and how long isn't compared."""
    results = hd.dispatch(_parsed(spark, sf_dir), _sample_handler, ordered=False, decode=json.loads)
    return hd.processing_metrics(results).withColumn("timed", F.col("t_decode_us") > 0).drop("t_handle_us", "t_decode_us")


@query
def typed_handler_totals(spark, sf_dir):
    """Events of all types, each handled with the schema of its kind, and how many could not be decoded."""
    lines = env.valid_lines(env.parse_lines(_lines(spark, sf_dir, corrupt=True)))
    keys = ["event_type", "partition"]
    totals = []
    for change in (False, True):
        own = lines.filter(F.col("event_type").isin(*tb.DATA_TYPES) == F.lit(change))
        value = F.col("decoded.data.value" if change else "decoded.value")

        def total(decoded: DataFrame, value: Column = value) -> DataFrame:
            cents = F.round(value * 100).cast("long")
            return decoded.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_events"), F.sum(cents).alias("cents"))

        schema, required = (data_change_event(PAYLOAD), "data.value") if change else (business_event(PAYLOAD), "value")
        good, bad = hd.typed_handler(own, schema, total, (required,), on_decode_error="route")
        errors = bad.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_bad"))
        totals.append(good.join(errors, keys, "full"))
    none = F.lit(0).cast("long")
    return totals[0].unionByName(totals[1]).select(
        *keys, F.coalesce("n_events", none).alias("n_events"), "cents", F.coalesce("n_bad", none).alias("n_bad")
    )


# --- liveness and metrics -------------------------------------------------------------


@query
def quiet_streams(spark, sf_dir):
    lines = env.parse_lines(_lines(spark, sf_dir))
    policy = liveness.StreamDeadPolicy("no_events_for", 40_000)
    return liveness.quiet_periods(
        lines, tb.as_of(), policy, 10_000, 15_000
    ).drop("open")


@query
def stream_metrics(spark, sf_dir):
    table = metrics.stream_metrics(env.parse_lines(_lines(spark, sf_dir)))
    return table.withColumn("window_start_us", _us("window_start")).drop("window_start")


@query
def event_type_registry(spark, sf_dir):
    table = tb.events(spark, sf_dir).groupBy(F.col("event_type").alias("name")).agg(
        F.min("ts").alias("created_at"), F.count(F.lit(1)).alias("n_events")
    )
    category = F.when(F.col("name").isin(*tb.DATA_TYPES), "data").otherwise("business")
    listed = registry.event_types(table).withColumn("asked", F.lit("all"))
    found = listed.unionByName(registry.event_types(table, "purchase").withColumn("asked", F.lit("purchase")))
    return found.withColumn("category", category).select("asked", "name", "category", _us("created_at").alias("created_us"), "n_events")


@query
def subscription_list(spark, sf_dir):
    """One subscription per user, over the event types the user has."""
    table = tb.events(spark, sf_dir).groupBy("user_id").agg(
        F.array_sort(F.collect_set("event_type")).alias("event_types"),
        F.date_trunc("day", F.min("ts")).alias("created_at"),
    )
    table = table.select(
        F.concat(F.lit("sub-"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias("id"),
        F.concat(F.lit("app-"), (F.col("user_id") % 3).cast("string")).alias("owning_application"),
        "event_types",
        "created_at",
    )
    listed = registry.subscriptions(table, "click", "app-1", offset=5)
    return listed.select("id", "owning_application", F.array_join("event_types", ",").alias("event_types"), _us("created_at").alias("created_us"))


# --- streams --------------------------------------------------------------------------


STREAM_FILES = 6
# Rows of a file of a micro-batch, about.
STREAM_FILE_ROWS = 20_000


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, in the shape of the log without offsets."""
    return tb.to_log_rows(_stream_of(tb.events(spark, sf_dir), _us("ts")))


def _stream_of(table: DataFrame, order: Column) -> DataFrame:
    """A table as a stream of STREAM_FILES micro-batches in the order of a number.

    Each micro-batch is a folder of equally many files, whose number grows with the table, so that none is written or
    read by one task. A folder that lacks some, as a range of few rows does, gets empty ones.
    """
    spark = table.sparkSession
    path, schema = scratch_path(spark, "stream"), table.schema
    table = table.withColumn("_order", order.cast("double"))
    ends = table.approxQuantile("_order", [k / STREAM_FILES for k in range(1, STREAM_FILES)], 0.01)
    place = sum((F.col("_order") > end).cast("int") for end in ends)
    n_files = max(1, -(-table.count() // (STREAM_FILES * STREAM_FILE_ROWS)))
    for k in range(STREAM_FILES):
        folder = f"{path}/range-{k}"
        table.filter(place == k).drop("_order").coalesce(n_files).write.parquet(folder)
        for _ in range(n_files - len(spark.read.schema(schema).parquet(folder).inputFiles())):
            spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(folder)
    # Files are taken in the order of their times; the folders are written one after the other.
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", n_files)
    return reader.parquet(f"{path}/range-*")


def _frame_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_of(_lines(spark, sf_dir), _us("started_at"))


def _run(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there and read the result."""
    out = scratch_path(stream.sparkSession, name)
    stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").trigger(
        availableNow=True
    ).start(f"{out}/rows").awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{out}/rows")


@query
def streamed_partition_activity(spark, sf_dir):
    stream = ss.partition_activity(_event_stream(spark, sf_dir), 7200, event_time="received_at")
    return _run(stream, "activity")


@query
def streamed_liveness(spark, sf_dir):
    lines = env.parse_lines(_frame_stream(spark, sf_dir))
    processor = ss.StreamLiveness(liveness.StreamDeadPolicy("no_events_for", 40_000), 10_000, 15_000)
    rows = lines.select("stream_id", "kind", "started_at")
    return _run(ss.with_state(rows, ["stream_id"], processor, event_time="started_at"), "liveness")


def _count_batch(state: dict | None, batch: dict) -> dict:
    return {"n": (state or {"n": 0})["n"] + 1, "last": int(batch["frame_id"])}


def _keep_even(state: dict, idle_us: int) -> bool:
    return state["last"] % 2 == 0


@query
def streamed_handler_slots(spark, sf_dir):
    lines = env.event_batches(env.valid_lines(env.parse_lines(_frame_stream(spark, sf_dir))))
    processor = ss.HandlerSlot(_count_batch, _keep_even, 86_400)
    rows = lines.select(*ETP, "frame_id", "started_at")
    slots = _run(ss.with_state(rows, ETP, processor, event_time="started_at"), "slots")
    return slots.select(*ETP, "what", "at_us")


@query
def streamed_first_receptions(spark, sf_dir):
    rows = _event_stream(spark, sf_dir).select("eid", "received_at", "event_id")
    again = F.explode(F.when(F.col("event_id") % 9 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    doubled = rows.select("eid", "received_at", again.alias("copy"))
    return _run(sc.distinct_events(doubled, "1 minute"), "distinct").select("eid", _us("received_at").alias("received_us"))


STREAM_LIMIT = 777


def _commit_all(events: list[str], meta: hd.BatchMeta) -> str:
    return hd.COMMIT


@query
def streamed_commits(spark, sf_dir):
    """Offsets are texts whose order nobody knows but the broker."""
    frames = _frame_stream(spark, sf_dir)
    opaque = F.regexp_replace("value", '"offset":"([0-9]+)"', '"offset":"001-0001-$1"')
    out = scratch_path(spark, "consumed")
    sc.consume(frames.withColumn("value", opaque), _commit_all, out).awaitTermination()
    return sc.committed(spark, out).select(*ETP, "committed", "committed_text")


@query
def streamed_commits_after_reset(spark, sf_dir):
    """Numbers as offsets, and partitions set back after the last micro-batch."""
    out = scratch_path(spark, "consumed")
    sc.consume(_frame_stream(spark, sf_dir), _commit_all, out).awaitTermination()
    back = sc.committed(spark, out).filter(F.col("partition").cast("int") % 2 == 0)
    sc.reset(spark, out, back.select(*ETP, F.when(F.col("partition") == "0", F.lit("begin")).otherwise(F.lit("3")).alias("offset")))
    return sc.committed(spark, out)


@query
def streamed_limit(spark, sf_dir):
    """The stream limit is the feature here: the handlers get exactly so many events."""
    out, progress = scratch_path(spark, "limited"), sc.Progress()
    query = sc.consume(_frame_stream(spark, sf_dir), _commit_all, out, stream_limit=STREAM_LIMIT, progress=progress)
    ended = sc.run_with_limits(query, stream_limit=STREAM_LIMIT, count=progress.count)
    results = spark.read.parquet(f"{out}/results/batch=*")
    return results.agg(
        F.sum("n_events").cast("long").alias("n_events"), F.lit(progress.count()).cast("long").alias("counted"),
        F.lit(ended in ("limit", "ended")).alias("ended"),
    )


@query
def streamed_stops(spark, sf_dir):
    """A scope that was stopped gets no calls any more, in no later micro-batch."""
    out = scratch_path(spark, "stopped")
    sc.consume(_frame_stream(spark, sf_dir), _sample_handler, out, on_stop="hold").awaitTermination()
    results = spark.read.parquet(f"{out}/results/batch=*")
    return results.select("stream_id", *ETP, "frame_id", "action", "settled")


@query
def live_metrics(spark, sf_dir):
    """What a user function was told while the lines of a stream passed, summed up."""
    told: list[dict] = []
    receiver = metrics.MetricsReceiver(lambda name, batch_id, values: told.append(values))
    spark.streams.addListener(receiver)
    try:
        lines = metrics.observed(env.parse_lines(_frame_stream(spark, sf_dir)))
        rows = _run(lines.select("stream_id", "n_events"), "observed")
        deadline = time.monotonic() + 30
        # Listeners are told by another thread, after the query has ended.
        while sum(v["frames_received"] for v in told) < rows.count() and time.monotonic() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(receiver)
    sums = [sum(v[name] or 0 for v in told) for name in metrics.LIVE_METRICS]
    return spark.createDataFrame([(*sums, len(told) >= STREAM_FILES)], ", ".join(f"{n} long" for n in metrics.LIVE_METRICS) + ", each boolean")


@query
def stream_lifecycle(spark, sf_dir):
    """The life of a stream that was run, stopped and run again, as its listener wrote it down."""
    path, out = scratch_path(spark, "lifecycle"), scratch_path(spark, "ran")
    life = sc.LifecycleTable(spark, path)
    frames = _frame_stream(spark, sf_dir)
    spark.streams.addListener(life)
    try:
        for k in range(2):
            writer = frames.select("stream_id").writeStream.format("noop").option("checkpointLocation", f"{out}/{k}")
            writer.trigger(availableNow=True).start().awaitTermination()
            deadline = time.monotonic() + 30
            # Listeners are told by another thread, after the query has ended.
            while life.n_stopped <= k and time.monotonic() < deadline:
                time.sleep(0.1)
    finally:
        spark.streams.removeListener(life)
    rows = spark.read.parquet(path)
    return rows.groupBy("event").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("run_id").alias("n_runs"), F.count("detail").alias("n_errors")
    )
