"""What the operators of this subpackage share: column choice, Arrow mapping, connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.session import stored

Rows = Iterator[pa.RecordBatch]

#: Column of the row key in :func:`keyed` tables, and where a column of that name waits meanwhile.
ROW, _HELD = "__row", "__row_of_table"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, so that other columns of any name cannot clash; a null text is empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )


def release_memory() -> None:
    """Give back what a task no longer uses: its worker lives on for other tasks, beside the executor's own memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_batches(rows: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema: str | T.StructType) -> DataFrame:
    """``step`` on every Arrow batch where it lies; no shuffle."""

    def run(batches: Rows) -> Rows:
        try:
            for batch in batches:
                out = step(batch)
                yield from out.to_batches() if isinstance(out, pa.Table) else (out,)
        finally:
            release_memory()

    return rows.mapInArrow(run, schema)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of each row, written to the shared folder, so that the keys stay the same."""
    return stored(docs.withColumnRenamed(ROW, _HELD).withColumn(ROW, F.monotonically_increasing_id()), "keyed")


def without_rows(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of a :func:`keyed` table whose key isn't in ``dropped`` (one column of keys), without the key."""
    # A short stored list is known to be short, so the rows stay where they are.
    return rows.join(stored(dropped.toDF(ROW), "dropped"), ROW, "left_anti").drop(ROW).withColumnRenamed(_HELD, ROW)


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``; the root is the smallest node of its component.

    Alternating star contraction: the large-star step hangs the larger neighbours of a node on its smallest
    neighbour, the small-star step the smaller ones. Each round is written to the shared folder, so the
    lineage stays short; the number of rounds grows with the logarithm of the longest chain. No neighbour
    list is ever gathered: a step is a minimum by node and a join.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name
    )
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(large.where("u <> v").distinct(), name)
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        down = edges.join(low, "u")
        small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        edges = stored(small.where("u <> v").distinct(), name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
