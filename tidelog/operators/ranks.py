"""The first n rows of a total order, and the rest, found without sorting the table.

A histogram of the leading order value tells in which of its buckets the n-th row lies; that bucket
is divided again until it holds few rows or a single value. Only its rows are ranked, and the
n-th row becomes a filter on the table, which is pushed to the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F

from tidelog.operators.segments import segmented_scan
from tidelog.session import stored

# Buckets of a histogram, and rows of the bucket that is ranked without dividing it again.
BUCKETS = 4096
RANKED_ROWS = 100_000


def _counts(values: DataFrame, low: int, width: int) -> list[Row]:
    bucket = F.expr(f"(v - {low}L) div {width}L").alias("bucket")
    return values.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).orderBy("bucket").collect()


def nth_row(df: DataFrame, value: Column, ties: Sequence[str], n: int, ranked_rows: int = RANKED_ROWS) -> Row | None:
    """The n-th row (from 1) by ``value`` (BIGINT, NULL first) and ``ties``: its value as ``v``, and the ties.

    None if there are fewer rows. At most BUCKETS counts come to the driver at a time.
    """
    rows = df.select(value.alias("v"), *ties)
    ends = rows.agg(F.min("v"), F.max("v"), F.count("v"), F.count(F.lit(1))).first()
    low, high, n_known, n_rows = ends
    if n < 1 or n > n_rows:
        return None
    left = n - (n_rows - n_known)
    if left <= 0:
        inside, left = F.col("v").isNull(), n
    else:
        inside, held = F.col("v").isNotNull(), n_known
        while held > ranked_rows and low < high:
            width = (high - low) // BUCKETS + 1
            for bucket in _counts(rows.filter(inside).select("v"), low, width):
                if left <= bucket["n"]:
                    break
                left -= bucket["n"]
            held = bucket["n"]
            low, high = low + bucket["bucket"] * width, min(high, low + (bucket["bucket"] + 1) * width - 1)
            inside = F.col("v").between(low, high)
    ranked = segmented_scan(stored(rows.filter(inside), "ranked"), [], ["v", *ties], row_number="_rank")
    return ranked.filter(F.col("_rank") == left).drop("_rank").first()


def _upto(df: DataFrame, value: Column, ties: Sequence[str], last: Row) -> Column:
    """Whether a row comes no later than ``last``; a condition on the value alone stands first."""
    kinds = dict(df.select(value.alias("v"), *ties).dtypes)
    key = F.struct(value.alias("v"), *ties)
    cut = F.struct(*[F.lit(last[c]).cast(kinds[c]).alias(c) for c in ("v", *ties)])
    if last["v"] is None:
        return value.isNull() & (key <= cut)
    return (value.isNull() | (value <= last["v"])) & (key <= cut)


def first_rows(df: DataFrame, value: Column, ties: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``value`` and ``ties``, in no order."""
    last = nth_row(df, value, ties, n)
    if last is None:
        return df if n > 0 else df.limit(0)
    return df.filter(_upto(df, value, ties, last))


def rows_after(df: DataFrame, value: Column, ties: Sequence[str], n: int) -> DataFrame:
    """All but the first ``n`` rows by ``value`` and ``ties``, in no order."""
    last = nth_row(df, value, ties, n)
    if last is None:
        return df.limit(0) if n > 0 else df
    return df.filter(~_upto(df, value, ties, last))
