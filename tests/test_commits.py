import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidelog.operators import commits as cm

from helpers import at, rows, us

SCHEMA = (
    "stream_id string, event_type string, partition string, offset long, frame_id long, seq long,"
    " started_at timestamp, arrived_at timestamp, n_events long"
)


def cursors(spark, *items, stream="s"):
    """Items are (started, arrived, n_events), in order."""
    data = [(stream, "e", str(i % 2), i, i, i, at(s), at(a), n) for i, (s, a, n) in enumerate(items)]
    return spark.createDataFrame(data, SCHEMA)


def cut(df, strategy, timeout=60, **options):
    got = cm.cut_commits(df, strategy, commit_timeout_secs=timeout, **options)
    return [(r["commit_no"], r["trigger"], r["triggered_us"]) for r in got.orderBy("stream_id", "seq").collect()]


def test_immediately(spark):
    df = cursors(spark, (0, 1, 3), (1, 2, 3))
    assert cut(df, cm.CommitStrategy("immediately")) == [(1, "deadline", us(1)), (2, "deadline", us(2))]


def test_first_cursor_of_an_interval_strategy_commits_at_once(spark):
    df = cursors(spark, (0, 0, 1), (1, 1, 1), (2, 2, 1), (3, 3, 1))
    got = cut(df, cm.CommitStrategy("after", cursors=2))
    assert got == [(1, "deadline", us(0)), (2, "batches", us(2)), (2, "batches", us(2)), (3, "stream_end", None)]


def test_interval_passes_between_cursors(spark):
    df = cursors(spark, (0, 0, 1), (5, 5, 1), (10, 10, 1), (31, 31, 1))
    # The clock restarts at 0, falls due at 10 with the third cursor just in, and at 20 nothing is pending.
    got = cut(df, cm.CommitStrategy("after", seconds=10))
    assert got == [(1, "deadline", us(0)), (2, "deadline", us(10)), (2, "deadline", us(10)), (3, "deadline", us(31))]
    df = cursors(spark, (0, 0, 1), (5, 5, 1), (12, 12, 1))
    assert cut(df, cm.CommitStrategy("after", seconds=10))[1:] == [(2, "deadline", us(10)), (3, "stream_end", None)]


def test_deadline_before_events_before_cursors(spark):
    df = cursors(spark, (0, 0, 1), (0, 1, 5), (0, 2, 5))
    assert cut(df, cm.CommitStrategy("after", events=10, cursors=2))[1:] == [(2, "events", us(2))] * 2
    late = cursors(spark, (0, 0, 1), (0, 59, 10))
    assert cut(late, cm.CommitStrategy("after", seconds=100, events=10, cursors=1))[1] == (2, "deadline", us(59))


def test_latest_possible_uses_the_safe_timeout(spark):
    df = cursors(spark, (0, 0, 1), (50, 59, 1), (58, 59.5, 1))
    got = cut(df, cm.CommitStrategy("latest_possible"))
    assert got == [(1, "deadline", us(59)), (1, "deadline", us(59)), (2, "stream_end", None)]
    # The earliest frame counts, also when it comes in last.
    df = cursors(spark, (50, 51, 1), (0, 52, 1), (53, 60, 1))
    assert cut(df, cm.CommitStrategy("latest_possible"))[0] == (1, "deadline", us(59))


def test_safe_timeout():
    assert [cm.safe_timeout_us(s) for s in (60, 2, 1, 0)] == [59_000_000, 1_000_000, 500_000, 59_000_000]


def test_strategy_rules():
    derived = cm.derived_strategy(5000, 100)
    assert (derived.seconds, derived.cursors, derived.events) == (1, 37, 3750)
    assert cm.derived_strategy(8, 0).events == 10
    for bad in (dict(seconds=0), dict(seconds=1, cursors=0), dict(cursors=1, events=0), {}):
        with pytest.raises(ValueError):
            cm.CommitStrategy("after", **bad)
    assert cm.CommitStrategy("after", cursors=1).interval_secs == 10


def simulated(items, interval, max_cursors, max_events, safe):
    """The committer as a clock-driven loop: time steps from one moment of interest to the next."""
    commits, pending, clock = [], [], 0.0 if interval is not None else float("inf")
    queue = list(enumerate(items))
    now = float("-inf")
    while queue or pending:
        due = min([items[i][0] + safe for i in pending] + [clock]) if pending else float("inf")
        arrival = queue[0][1][1] if queue else float("inf")
        if due == arrival == float("inf") or (not queue):
            break
        now = max(now, min(due, arrival))
        if arrival <= now:
            pending.append(queue.pop(0)[0])
        if not pending:
            continue
        trigger = None
        if min(items[i][0] + safe for i in pending) <= now:
            trigger = "deadline"
        elif sum(items[i][2] for i in pending) >= max_events:
            trigger = "events"
        elif len(pending) >= max_cursors:
            trigger = "batches"
        elif clock <= now:
            trigger = "deadline"
        if trigger:
            commits.append((list(pending), trigger, now))
            pending = []
            if interval is not None:
                clock = now + interval
    if pending:
        commits.append((pending, "stream_end", None))
    out = {}
    for no, (members, trigger, t) in enumerate(commits, 1):
        for i in members:
            out[i] = (no, trigger, None if t is None else us(t))
    return [out[i] for i in range(len(items))]


@pytest.mark.parametrize("seed", range(8))
def test_cuts_equal_a_simulation_whatever_the_segments(spark, seed):
    rnd = random.Random(seed)
    items, now = [], 1.0
    for _ in range(120):
        now += rnd.choice([0, 0.25, 1, 1, 3, 30])
        items.append((now - rnd.choice([0, 1, 5]), now, rnd.randrange(6)))
    interval, n_cursors, n_events, timeout = rnd.choice([(4, 5, 9, 8), (7, 100, 12, 60), (3, 4, 1000, 6), (None, 10**9, 10**9, 11)])
    want = simulated(items, interval, n_cursors, n_events, timeout - 1)
    kind = cm.CommitStrategy("latest_possible") if interval is None else cm.CommitStrategy("after", interval, n_cursors, n_events)
    df = cursors(spark, *items).unionByName(cursors(spark, *items[:50], stream="t"))
    want_t = simulated(items[:50], interval, n_cursors, n_events, timeout - 1)
    assert cut(df, kind, timeout) == want + want_t
    if seed < 2 or interval is None:
        assert cut(df, kind, timeout, segment_rows=17) == want + want_t


def test_entries_ages_and_metrics(spark):
    df = cursors(spark, (0, 0, 1), (1, 1, 2), (2, 2, 3), (3, 3, 4))
    cutted = cm.cut_commits(df, cm.CommitStrategy("after", cursors=3))
    entries = cm.commit_table(cutted)
    got = rows(entries, "commit_no", "partition", "offset", "n_batches", "n_events")
    assert got == [(1, "0", 0, 1, 1), (2, "0", 2, 1, 3), (2, "1", 3, 2, 6)]
    aged = cm.cursor_ages(entries, F.lit(at(60)), 60)
    assert rows(aged, "commit_no", "partition", "first_age_us", "warning")[0] == (1, "0", 60_000_000, True)
    assert [tuple(r)[1:] for r in cm.commit_metrics(cutted).orderBy("trigger").collect()] == [
        ("batches", 1, 3, 9, 3, 9),
        ("deadline", 1, 1, 1, 1, 1),
    ]


def test_outcomes(spark):
    data = [("sub", "e", "0", 5, 1), ("sub", "e", "0", 5, 2), ("sub", "e", "0", 3, 3), ("sub", "e", "0", 6, 4), ("sub", "e", "1", 0, 5)]
    df = spark.createDataFrame(data, "subscription_id string, event_type string, partition string, offset long, t long")
    for n in (None, 5):
        out = cm.commit_outcomes(df, ["t"], segments=n)
        assert [r["result"] for r in out.orderBy("t").collect()] == ["committed", "outdated", "outdated", "committed", "committed"]
    assert cm.all_committed(out).first()[0] is False
    assert cm.all_committed(out.limit(0)).first()[0] is True
    assert cm.with_result(out, "outdated").count() == 2


def test_commits_never_go_back_but_by_a_reset(spark):
    data = [("sub", "s", "e", "0", 5, at(1), False), ("sub", "s", "e", "1", 7, at(1), False)]
    df = spark.createDataFrame(data, "subscription_id string, stream_id string, event_type string, partition string, offset long, committed_at timestamp, reset boolean")
    begin = df.unionByName(cm.reset_cursors(df, F.lit(at(2))))
    assert rows(cm.effective_commits(begin), "partition", "committed") == [("0", -1), ("1", -1)]
    to = spark.createDataFrame([("e", "1", 3)], "event_type string, partition string, offset long")
    given = df.unionByName(cm.reset_cursors(df, F.lit(at(2)), to, "sub"))
    with pytest.raises(ValueError, match="subscription_id"):
        cm.reset_cursors(df, F.lit(at(2)), to)
    never = to.union(spark.createDataFrame([("e", "9", 4)], to.schema))
    both = df.unionByName(cm.reset_cursors(df, F.lit(at(2)), never, "sub"))
    assert rows(cm.effective_commits(both), "partition", "committed") == [("0", 5), ("1", 3), ("9", 4)]
    assert rows(cm.effective_commits(given), "partition", "committed") == [("0", 5), ("1", 3)]
    later = given.unionByName(df.filter("partition = '1'").withColumn("committed_at", F.lit(at(3))).withColumn("offset", F.lit(4).cast("long")))
    assert rows(cm.effective_commits(later), "partition", "committed") == [("0", 5), ("1", 4)]


def test_every_batch_is_in_exactly_one_commit(spark):
    rnd = random.Random(9)
    items = [(i, i + 0.5, rnd.randrange(4)) for i in range(60)]
    got = cut(cursors(spark, *items), cm.CommitStrategy("after", seconds=5, events=6))
    sizes = defaultdict(int)
    for no, *_ in got:
        sizes[no] += 1
    assert sum(sizes.values()) == 60 and sorted(sizes) == list(range(1, len(sizes) + 1))
