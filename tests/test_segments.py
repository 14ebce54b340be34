import random

import pytest
from pyspark.sql import functions as F, types as T

from tidelog.operators.offsets import number_rows
from tidelog.operators.segments import carry_scan, chained_cuts, position_segment, ranged, segmented_scan
from tidelog.operators.sequence import activity_intervals, batches_by_timespan, order_inversions
from tidelog.plans import tables as tb

from helpers import at, rows

SF = "/root/testdata/sf0.001"


def skewed(spark, n=2000, seed=1):
    """Two thirds of the rows share a key, and many share an order value."""
    rnd = random.Random(seed)
    data = [("hot" if rnd.random() < 0.66 else f"k{rnd.randrange(5)}", rnd.choice([7, rnd.randrange(50)]), i, rnd.randrange(100)) for i in range(n)]
    return data, spark.createDataFrame(data, "k string, t int, id int, v int")


@pytest.mark.parametrize("segments", [60, 5, 1, None])
def test_running_columns_do_not_depend_on_segments(spark, segments):
    data, df = skewed(spark)
    got = segmented_scan(
        df,
        ["k"],
        ["t", "id"],
        segments,
        row_number="rn",
        running_sum={"s": F.col("v")},
        running_max={"m": F.col("v")},
        max_before={"b": F.col("v")},
        lag={"p": "v"},
    )
    want = []
    for key in {d[0] for d in data}:
        s, m, p = 0, None, None
        for rn, (k, t, i, v) in enumerate(sorted((d for d in data if d[0] == key), key=lambda d: d[1:3]), 1):
            before = m
            s, m = s + v, v if m is None else max(m, v)
            want.append((k, t, i, v, rn, s, m, before, p))
            p = v
    assert rows(got.select("k", "t", "id", "v", "rn", "s", "m", "b", "p")) == sorted(want, key=repr)


def test_segments_are_bounded_under_skew(spark):
    _, df = skewed(spark, 4000)
    sizes = ranged(df, ["k", "t", "id"], 20).groupBy("k", "_segment").count().agg(F.max("count")).first()[0]
    # Bounds come from a sample, so segments are about, not exactly, of a size.
    assert sizes <= 600


def test_input_is_evaluated_once(spark):
    """One scan of the source in the plan, and no cut points in it."""
    _, df = skewed(spark)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = df.mapInArrow(counted, df.schema)
    segmented_scan(rows, ["k"], ["id"], position_segment("id", 100), row_number="rn").collect()
    assert seen.value == 2000


def test_order_segment_on_times(spark):
    df = spark.createDataFrame([(at(i // 3), i) for i in range(300)], "t timestamp, id int")
    numbered = number_rows(df.withColumn("k", F.lit(1)), ["k"], ["t", "id"], "n", segments=15)
    assert numbered.filter(F.col("n") != F.col("id")).count() == 0


@pytest.mark.parametrize("limit", [5, 40, 10**6])
def test_carry_scan_is_the_sequential_rule(spark, limit):
    """A resetting sum, which knows nothing of segments; the last one never resets."""
    data, df = skewed(spark, 600)
    df = number_rows(df, ["k"], ["t", "id"], "n")

    def step(pdf, entry):
        total = 0 if entry is None else entry[0]
        out = []
        for v in pdf["v"].tolist():
            total += v
            out.append(total)
            if total >= limit * 10:
                total = 0
        return pdf[["k", "n"]].assign(total=out), (total,)

    state = T.StructType([T.StructField("total", T.LongType())])
    output = T.StructType([df.schema["k"], T.StructField("n", T.LongType()), T.StructField("total", T.LongType())])
    got = carry_scan(df, ["k"], "n", step, state, output, segment_rows=45)
    want = []
    for key in {d[0] for d in data}:
        total = 0
        for n, d in enumerate(sorted((d for d in data if d[0] == key), key=lambda d: d[1:3])):
            total += d[3]
            want.append((key, n, total))
            if total >= limit * 10:
                total = 0
    assert rows(got) == sorted(want, key=repr)


def test_log_and_frames_do_not_depend_on_segments(spark):
    whole, cut = tb.log(spark, SF), tb.log(spark, SF, segments=17)
    assert rows(whole) == rows(cut)
    assert rows(tb.frames(whole)) == rows(tb.frames(cut, segments=11))


def test_sequence_operators_do_not_depend_on_segments(spark):
    log = tb.log(spark, SF).cache()
    for run in (
        lambda n: activity_intervals(log, 50_000, segment_rows=n),
        lambda n: batches_by_timespan(log, 200_000, segment_rows=n),
        lambda n: order_inversions(log, ["key"], segment_rows=n, segments=7 if n == 4 else None),
    ):
        assert rows(run(1_000_000)) == rows(run(4))


@pytest.mark.parametrize("segments", [24, None])
def test_null_keys_are_a_key(spark, segments):
    rnd = random.Random(4)
    data = [(rnd.choice([None, None, "a"]), None if i == 3 else i, i) for i in range(120)]
    df = spark.createDataFrame(data, "k string, t int, id int")
    got = {(r["k"], r["id"]): r["n"] for r in number_rows(df, ["k"], ["t", "id"], "n", segments=segments).collect()}
    for key in (None, "a"):
        own = sorted((d for d in data if d[0] == key), key=lambda d: (d[1] is not None, d[1] or 0, d[2]))
        assert [got[key, d[2]] for d in own] == list(range(len(own)))


@pytest.mark.parametrize("segment_rows", [4, 1_000_000])
def test_null_partitions_in_sequence_operators(spark, segment_rows):
    data = [(None if i % 2 else "e", None if i % 3 else "0", i, at(100 * i)) for i in range(60)]
    log = spark.createDataFrame(data, "event_type string, partition string, offset long, received_at timestamp")
    keys = {(d[0], d[1]) for d in data}
    intervals = activity_intervals(log, 700, segment_rows=segment_rows).collect()
    batches = batches_by_timespan(log, 1000, segment_rows=segment_rows).collect()
    assert len(batches) == len(data) and {(r["event_type"], r["partition"]) for r in batches} == keys
    for key in keys:
        times = [d[3].timestamp() for d in data if (d[0], d[1]) == key]
        assert sum(r["n_events"] for r in intervals if (r["event_type"], r["partition"]) == key) == len(times)
        anchor, number, want = None, -1, []
        for t in times:
            if anchor is None or t - anchor > 1000:
                anchor, number = t, number + 1
            want.append(number)
        assert [r["batch_no"] for r in sorted(batches, key=lambda r: r["offset"]) if (r["event_type"], r["partition"]) == key] == want


def test_position_segment(spark):
    df = spark.createDataFrame([(-1,), (0,), (9,), (10,)], "x long")
    assert [r[0] for r in df.select(position_segment("x", 10)).collect()] == [-1, 0, 0, 1]


@pytest.mark.parametrize("through", [False, True])
@pytest.mark.parametrize("segment_rows", [3, 16, 100_000])
def test_chained_cuts_follow_the_pointers(spark, through, segment_rows):
    rnd = random.Random(segment_rows)
    data = []
    for key, n in (("hot", 300), (None, 40), ("one", 1), ("slow", 25)):
        level, least = 0, []
        for i in range(n):
            level += rnd.choice([0, 0, 1, 2, 30]) if key != "slow" else 100
            least.append((key, 3 * i, level, level + rnd.choice([0, 1, 4, 25]) + (not through)))
        # Limits must not fall along the rows.
        for i in range(n - 2, -1, -1):
            least[i] = (*least[i][:3], min(least[i][3], least[i + 1][3]))
        data += least
    df = spark.createDataFrame(data, "k string, pos long, lvl long, lim long")
    got = chained_cuts(df, ["k"], "pos", "lvl", "lim", through_limit=through, segment_rows=segment_rows)
    want = []
    for key in {d[0] for d in data}:
        piece, limit = 0, None
        for k, pos, level, u in (d for d in data if d[0] == key):
            if limit is None:
                limit = u
            elif level > limit or level == limit and not through:
                piece, limit = piece + 1, u
            want.append((k, pos, piece, limit))
            if through and level == limit:
                piece, limit = piece + 1, None
    assert rows(got.select("k", "pos", "piece", "piece_until")) == sorted(want, key=repr)


def test_a_long_chain_over_many_segments(spark):
    """Ways that never meet: every third row, whatever the first one is."""
    df = spark.range(20_000).select(F.lit("k").alias("k"), F.col("id").alias("pos"), F.col("id").alias("lvl"), (F.col("id") + 3).alias("lim"))
    got = chained_cuts(df, ["k"], "pos", "lvl", "lim", segment_rows=50)
    assert got.filter("piece <> pos div 3 or piece_until <> pos - pos % 3 + 3").count() == 0 and got.count() == 20_000
