"""Longest previous factors against their definition, and anchors that are spread over buckets."""

import random

import numpy as np
import pytest

from tidelog.llm import suffix_dedup
from tests.llm import brute


@pytest.mark.parametrize("seed", range(20))
def test_factor_lengths(seed):
    rng = random.Random(seed)
    size = rng.choice([8, 13, 16, 50])
    data = bytes(rng.choice(b"ab" if seed % 2 else b"abcdefgh") for _ in range(400))
    starts = np.array(rng.choices(range(400 - size), k=rng.choice([0, 1, 2, 150])), np.int64)
    ids = np.array([rng.randrange(12) for _ in starts], np.int64)
    order, common = suffix_dedup.suffix_order(np.frombuffer(data, np.uint8), starts, size)
    cut = [data[s : s + size] for s in starts[order]]
    assert cut == sorted(cut)
    assert common.tolist()[1:] == [_common(a, b) for a, b in zip(cut, cut[1:], strict=False)]
    own = ids[order]
    want = [max([_common(t, o) for o, j in zip(cut, own, strict=True) if j < i], default=0) for t, i in zip(cut, own, strict=True)]
    assert suffix_dedup.previous_factors(own, common).tolist() == want


def _common(a, b):
    return next((k for k, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), len(a))


@pytest.mark.parametrize("hot_runs", [0, 3, 50_000])
def test_hot_anchors(spark, monkeypatch, hot_runs):
    """One phrase in many contexts: dealt by anchor or by passage, the result is the same."""
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", hot_runs)
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 3_000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_ANCHORS", 300)
    monkeypatch.setattr(suffix_dedup, "PASSAGES", 700)
    rng = random.Random(5)
    phrase = "the same twenty-eight letters and a few more of them in every text"
    rows = []
    for k in range(120):
        left, right = ("".join(rng.choice("xyz ") for _ in range(rng.randrange(40))) for _ in "ab")
        rows.append((k // 2 if k % 7 else None, left + phrase[: rng.randrange(40, 66)] + right))
    rows += [(200 + k, phrase * 3) for k in range(30)] + [(3, phrase * 3), (3, phrase * 3), (4, ""), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs, keep_text=False).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.repeats(rows), key=repr)
