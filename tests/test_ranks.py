import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import ranks

from helpers import rows


def table(spark, seed):
    rnd = random.Random(seed)
    spread = rnd.choice([3, 1000, 10**12])
    data = [(rnd.choice([None, *(rnd.randrange(spread) for _ in range(6))]), f"t{i % 7}", i) for i in range(900)]
    data += [(spread // 2, "hot", 1000 + i) for i in range(400)]
    return data, spark.createDataFrame(data, "at long, name string, id int")


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("ranked_rows", [10, 100_000])
def test_first_rows_and_the_rest(spark, seed, ranked_rows, monkeypatch):
    monkeypatch.setattr(ranks.nth_row, "__defaults__", (ranked_rows,))
    monkeypatch.setattr(ranks, "BUCKETS", 7)
    data, df = table(spark, seed)
    ordered = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    for n in (0, 130, 1299, 5000):
        assert rows(ranks.first_rows(df, F.col("at"), ["name", "id"], n)) == sorted(ordered[:n], key=repr)
        assert rows(ranks.rows_after(df, F.col("at"), ["name", "id"], n)) == sorted(ordered[n:], key=repr)


def test_empty_table(spark):
    _, df = table(spark, 1)
    assert ranks.first_rows(df.limit(0), F.col("at"), ["id"], 3).collect() == []
    assert ranks.nth_row(df.limit(0), F.col("at"), ["id"], 1) is None
