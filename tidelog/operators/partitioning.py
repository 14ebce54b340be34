"""Partition assignment of events to publish."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidelog.functions.hashing import compound_key, key_hash, partition_of_hash


def sorted_partitions(partitions: DataFrame) -> DataFrame:
    """Partition ids with their place: by number if *all* ids are numbers, else by text.

    One row per partition id, so this is a small table.
    """
    ids = partitions.select("partition").distinct()
    number = F.when(F.col("partition").rlike(r"^\+?[0-9]+$"), F.col("partition").try_cast("decimal(20,0)"))
    number = F.when(number <= F.lit("18446744073709551615").cast("decimal(20,0)"), number)
    listed = ids.agg(
        F.bool_and(number.isNotNull()).alias("numeric"),
        F.array_sort(F.collect_list(F.struct(number.alias("n"), F.col("partition").alias("p")))).alias("by_number"),
        F.array_sort(F.collect_list("partition")).alias("by_text"),
    )
    return listed.select(
        F.posexplode(F.when(F.col("numeric"), F.transform("by_number", lambda r: r["p"])).otherwise(F.col("by_text"))).alias(
            "place", "partition"
        )
    )


def partition_list(partitions: DataFrame) -> list[str]:
    """The sorted ids as a Python list, for use as a literal in expressions."""
    return [r["partition"] for r in sorted_partitions(partitions).orderBy("place").collect()]


def partition_for_key(
    key: Column, partitions: Sequence[str], hasher: Callable[[Column], Column] = key_hash
) -> Column:
    """The partition of a key; ``hasher`` maps the key to a 64-bit hash."""
    if not partitions:
        raise ValueError("partitions may not be empty")
    return partition_of_hash(hasher(key), partitions)


def assign_partitions(
    events: DataFrame,
    key: Column | Callable[[DataFrame], Column],
    partitions: Sequence[str],
    *,
    hasher: Callable[[Column], Column] = key_hash,
    metadata: str = "metadata",
) -> DataFrame:
    """Set ``metadata.partition`` from the key each event yields."""
    key = key(events) if callable(key) else key
    return events.withColumn(
        metadata, F.col(metadata).withField("partition", partition_for_key(key, partitions, hasher))
    )


def assign_by_strategy(
    events: DataFrame,
    strategy: str,
    partitions: Sequence[str],
    *,
    key_fields: Sequence[str] = (),
    category: str = "business",
    eid: str = "eid",
    given: str = "partition",
) -> DataFrame:
    """Add ``assigned`` and ``rejection`` by an event type's partition strategy.

    * ``hash``: equal values of ``key_fields`` give equal partitions; the paths are
      below ``data`` for data-change events,
    * ``random``: even, and the same on every run because it follows from the eid; an event
      without one is rejected,
    * ``user_defined``: the partition is given and must exist.
    """
    rejection = F.lit(None).cast("string")
    if strategy == "hash":
        if not key_fields:
            raise ValueError("strategy hash needs key fields")
        prefix = "data." if category == "data" else ""
        assigned = partition_for_key(compound_key(*[F.col(prefix + f) for f in key_fields]), partitions)
    elif strategy == "random":
        assigned = partition_for_key(F.col(eid), partitions)
        rejection = F.when(F.col(eid).isNull(), F.lit("no eid"))
    elif strategy == "user_defined":
        known = F.coalesce(F.col(given).isin(*partitions), F.lit(False))
        assigned = F.when(known, F.col(given))
        rejection = F.when(F.col(given).isNull(), F.lit("no partition given")).when(
            ~known, F.concat(F.lit("unknown partition "), F.col(given))
        )
    else:
        raise ValueError(f"unknown partition strategy: {strategy}")
    return events.withColumn("assigned", assigned).withColumn("rejection", rejection)


def partition_count(read_parallelism: Column, write_parallelism: Column) -> Column:
    """Partitions an event type gets for its expected parallelism."""
    return F.greatest(read_parallelism, write_parallelism)
