"""Periodic runs against plain search over all periods."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from tests.llm.test_contracts import LONG, ODD_ROWS, SF, answers, frame
from tidelog.llm import periodic_runs, queries

COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def words(text):
    return text.encode().split()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60) | st.lists(st.sampled_from("abcd"), max_size=90), max_size=6))
def test_short_alphabets(texts):
    texts = [[w.encode() for w in t] for t in texts]
    assert periodic_runs.runs_of(texts) == [brute.runs(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(2, 40), st.integers(1, 3), st.integers(0, 9999)), max_size=7))
def test_repeated_pieces(parts):
    text = []
    for period, times, letters, seed in parts:
        rng = random.Random(seed)
        piece = [rng.choice("abcdefgh"[: letters * 2]).encode() for _ in range(period)]
        text += (piece * times)[: len(piece) * times - rng.randrange(period)]
    assert periodic_runs.runs_of([text, text[::-1]]) == [brute.runs(text), brute.runs(text[::-1])]


def test_nested_periods():
    rng = random.Random(1)
    inner = [b"x", b"y"] * 9 + [b"z"]
    outer = (inner * 5 + [rng.choice([b"p", b"q"]) for _ in range(30)]) * 6
    assert periodic_runs.runs_of([outer]) == [brute.runs(outer)]
    assert len(brute.runs(outer)) > 6


def test_fibonacci_words():
    a, b = [b"a"], [b"a", b"b"]
    for _ in range(11):
        a, b = b, b + a
    cube = b * 4
    assert periodic_runs.runs_of([b, cube]) == [brute.runs(b), brute.runs(cube)]


def test_very_long_text():
    text = [b"w%d" % (i % 5000) for i in range(200_000)]
    assert periodic_runs.runs_of([text]) == [[(0, 200_000, 5000)]]
    assert periodic_runs.runs_of([[b"a"] * 300_000]) == [[(0, 300_000, 1)]]


def test_selected_positions_depend_on_their_context_alone():
    rng = random.Random(2)
    text = [rng.randrange(3) for _ in range(3000)]
    import numpy as np

    levels = periodic_runs.window_names(np.array(text))
    for level in (2, 3):
        scale = 1 << level
        at = set(periodic_runs.synchronising_set(levels[level], scale, periodic_runs.direct_runs(np.array(text))).tolist())
        by_context = {}
        for i in range(len(text) - 2 * scale + 1):
            by_context.setdefault(tuple(text[i : i + 2 * scale]), set()).add(i in at)
        repeated = [c for c, seen in by_context.items() if len(seen) > 1]
        assert not repeated and at


@pytest.mark.parametrize("rows", [ODD_ROWS, [(i, " ".join("ab"[k % 7 % 2] for k in range(n))) for i, n in enumerate(range(120))]])
def test_rows(spark, rows):
    got = periodic_runs.find(frame(spark, rows), prepare=periodic_runs.planted_words, keep_text=False)
    assert answers(got, *COLUMNS) == brute.periodic(rows)


def test_texts_come_out(spark):
    row = periodic_runs.find(frame(spark, [(1, "x " + "ä b c " * 5 + "end")])).first()
    assert row["collapsed"] == "x ä b c end" and [tuple(r) for r in row["runs"]] == [(1, 15, 3)]


def test_empty_table(spark):
    assert periodic_runs.find(frame(spark, [])).collect() == []


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    wanted = brute.periodic(rows)
    assert answers(queries.op11_periodic_runs(spark, SF), *COLUMNS) == wanted
    assert sum(r[1] > 0 for r in wanted) > 5 and len(LONG) > 0
