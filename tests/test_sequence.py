from pyspark.sql import functions as F

from tidelog.operators import liveness, sequence as sq
from tidelog.operators.offsets import cursor_distance, cursor_lag, partition_stats, read_from, retained, stats_report, stream_limit, time_lag, unconsumed

from helpers import at, rows, us


def log(spark, *secs, partition="0"):
    data = [("e", partition, i, at(s)) for i, s in enumerate(secs)]
    return spark.createDataFrame(data, "event_type string, partition string, offset long, received_at timestamp")


def test_activity_at_the_limit(spark):
    # A gap of exactly the timeout keeps the partition active.
    for n in (1_000_000, 2):
        got = rows(sq.activity_intervals(log(spark, 0, 90, 180.000001 + 90), 90, F.lit(at(300)), segment_rows=n), "interval_no", "n_events", "active_us")
        assert got == [(1, 2, 90_000_000), (2, 1, 29_999_999)]


def test_activity_closed_before_the_end(spark):
    got = rows(sq.activity_intervals(log(spark, 0, 10), 90, F.lit(at(101))), "active_us")
    assert got == [(10_000_000,)]
    got = rows(sq.activity_intervals(log(spark, 0, 10), 90, F.lit(at(100))), "active_us")
    assert got == [(100_000_000,)]


def test_timespan_at_the_limit(spark):
    got = rows(sq.batches_by_timespan(log(spark, 0, 5, 10, 10.000001, 20, 20.000002), 10), "offset", "batch_no")
    assert got == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (5, 2)]


def test_batches_by_count(spark):
    late = log(spark, *range(7)).filter("offset >= 2")
    assert rows(sq.batches_by_count(late, 2), "offset", "batch_no") == [(2, 0), (3, 0), (4, 1), (5, 1), (6, 2)]
    assert rows(sq.batches_by_count(late, 2, dense=False), "offset", "batch_no") == [(2, 0), (3, 0), (4, 1), (5, 1), (6, 2)]


def test_quiet_streams_at_the_limits(spark):
    data = [("s", 0, at(0), "batch"), ("s", 1, at(30), "keep_alive"), ("s", 2, at(60), "batch"), ("s", 3, at(100), "batch")]
    lines = spark.createDataFrame(data, "stream_id string, frame_id long, started_at timestamp, kind string")
    policy = liveness.StreamDeadPolicy("no_frames_for", 40)
    got = rows(liveness.quiet_periods(lines, F.lit(at(141)), policy), "missing", "quiet_us", "open", "severity")
    assert got == [
        ("events", 60_000_000, False, "warning"),
        ("frames", 30_000_000, False, "warning"),
        ("frames", 30_000_000, False, "warning"),
        ("frames", 40_000_000, False, "warning"),
        ("frames", 41_000_000, True, "dead"),
    ]


def test_unconsumed_missing_is_not_zero(spark):
    stats = spark.createDataFrame([("a", 3), ("a", None), ("b", None), ("c", 0)], "event_type string, unconsumed long")
    assert rows(unconsumed(stats)) == [("a", 3, False), ("b", None, False), ("c", 0, True)]
    assert rows(stats_report(stats)) == [("a", 3), ("b", 0), ("c", 0)]


def test_lag_of_many_cursors_on_a_sparse_log(spark):
    sparse = log(spark, *range(20)).filter("offset % 3 = 0")
    cursors = spark.createDataFrame([("e", "0", -1), ("e", "0", 4), ("e", "0", 18), ("e", "9", 0)], "event_type string, partition string, offset long")
    for n in (1_000_000, 4):
        got = rows(cursor_lag(sparse, cursors, dense=False, segment_rows=n), "partition", "cursor_offset", "lag")
        assert got == [("0", -1, 7), ("0", 18, 0), ("0", 4, 5), ("9", 0, None)]


def test_distance_zero_only_for_equal(spark):
    pairs = spark.createDataFrame(
        [("e", "0", 5, "e", "0", 5), ("e", "0", 5, "e", "0", 9), ("e", "0", 5, "e", "0", 4)],
        "initial_event_type string, initial_partition string, initial_offset long,"
        " final_event_type string, final_partition string, final_offset long",
    )
    assert [r["distance"] for r in cursor_distance(pairs).collect()] == [0, 4, None]


def test_time_lag_and_retention(spark):
    events = log(spark, 0, 10, 20)
    held = spark.createDataFrame([("e", "0", 0)], "event_type string, partition string, committed long")
    assert time_lag(events, held, F.lit(at(35))).first()["lag_seconds"] == 25
    held = spark.createDataFrame([("e", "0", 2)], "event_type string, partition string, committed long")
    assert time_lag(events, held, F.lit(at(35))).first()["lag_seconds"] is None
    assert retained(events, 10_000, F.lit(at(20))).count() == 2


def test_start_positions_and_limit(spark):
    events = log(spark, 0, 1, 2)
    cursors = spark.createDataFrame([("e", "0", 0)], "event_type string, partition string, offset long")
    assert [read_from(events, s, cursors).count() for s in ("begin", "end", "cursors")] == [3, 0, 2]
    assert (stream_limit(events, 0).count(), stream_limit(events, 2).count()) == (3, 2)


def test_in_flight_running_totals(spark):
    d = spark.createDataFrame(
        [("s", at(0), 0, 1, 5, 50, 1, 5), ("s", at(1), 1, -1, -5, -50, 0, 0), ("s", at(1), 2, 1, 3, 30, 1, 3)],
        "stream_id string, at timestamp, seq long, batches_in_flight long, events_in_flight long, bytes_in_flight long,"
        " uncommitted_batches long, uncommitted_events long",
    )
    for n in (None, 3):
        got = [r["events_in_flight"] for r in sq.in_flight(d, segments=n).orderBy("seq").collect()]
        assert got == [5, 0, 3]
    end = sq.left_over(d).first()
    assert (end["uncommitted_events"], end["warning"]) == (8, True)
    assert us(1) - us(0) == 1_000_000


def test_lag_after_retention(spark):
    log = spark.createDataFrame([("e", "0", i) for i in range(100, 110)], "event_type string, partition string, offset long")
    cursors = spark.createDataFrame(
        [("e", "0", o) for o in (-1, 50, 99, 100, 104, 109, 200)] + [("e", "1", 7)], log.schema
    )
    want = [("0", -1, 10), ("0", 50, 10), ("0", 99, 10), ("0", 100, 9), ("0", 104, 5), ("0", 109, 0), ("0", 200, 0), ("1", 7, None)]
    for dense in (True, False):
        assert rows(cursor_lag(log, cursors, dense=dense), "partition", "cursor_offset", "lag") == sorted(want, key=repr)
    committed = spark.createDataFrame([("e", "0", 50)], "event_type string, partition string, committed long")
    assert partition_stats(log, committed).first()["unconsumed"] == 10
