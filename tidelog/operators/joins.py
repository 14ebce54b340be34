"""Joins of a big table with one that has a row per partition, scope or the like."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidelog.session import stored

BROADCAST_ROWS = 500_000


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    n_rows: int | None = None,
    *,
    null_safe: bool = False,
) -> DataFrame:
    """Join without shuffling ``big`` if ``small`` is proven to be small.

    ``n_rows`` is an upper bound of its rows when the caller knows one. Otherwise
    ``small`` is stored and counted. Beyond the limit it is an ordinary join, in which
    adaptive execution splits skewed keys.
    """
    if n_rows is None or n_rows > BROADCAST_ROWS:
        small = stored(small, "small")
        n_rows = small.count()
    small = F.broadcast(small) if n_rows <= BROADCAST_ROWS else small
    return join_null_safe(big, small, on, how) if null_safe else big.join(small, list(on), how)


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal columns where NULL equals NULL; an ordinary join in all else."""
    for name in on:
        right = right.withColumnRenamed(name, f"_on_{name}")
    met = reduce(lambda a, b: a & b, (left[name].eqNullSafe(right[f"_on_{name}"]) for name in on))
    return left.join(right, met, how).drop(*(f"_on_{name}" for name in on))


def join_shuffled(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join by a shuffle of both sides, however small Spark takes them to be.

    Spark doesn't count the rows that an explode adds, so it would broadcast a side many times larger than its
    estimate, through the driver's memory.
    """
    return left.join(right.hint("merge"), list(on), how)
