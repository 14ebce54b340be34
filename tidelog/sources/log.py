"""Event logs stored as ``event_type=…/partition=…`` folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidelog.operators.offsets import in_partitions, read_from

READ_SALTS = 16


def write_log(log: DataFrame, path: str, mode: str = "append", salts: int = READ_SALTS) -> None:
    """Append log rows. A busy partition is written by up to ``salts`` tasks."""
    placed = log.withColumn("_salt", F.pmod(F.xxhash64("eid"), F.lit(salts)))
    placed.repartition("event_type", "partition", "_salt").drop("_salt").write.mode(mode).partitionBy(
        "event_type", "partition"
    ).parquet(path)


def _typed(log: DataFrame) -> DataFrame:
    # Folder names are read back as numbers where they look like it.
    return log.withColumn("partition", F.col("partition").cast("string"))


def subscribe(
    log: DataFrame,
    event_types: Sequence[str],
    partitions: DataFrame | None = None,
    start: str = "begin",
    initial_cursors: DataFrame | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """The events a subscription reads: several event types, from a start position.

    On a stored log the event types prune folders. ``n_rows`` is an upper bound of the
    number of partitions.
    """
    wanted = log.filter(F.col("event_type").isin(*event_types))
    return read_from(in_partitions(wanted, partitions, n_rows), start, initial_cursors, n_rows)


def read_log(spark: SparkSession, path: str, event_types: Sequence[str] | None = None, **options) -> DataFrame:
    log = _typed(spark.read.parquet(path))
    return log if event_types is None else subscribe(log, event_types, **options)


def stream_log(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The log as a stream; ``max_files_per_trigger`` bounds what is in flight."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _typed(reader.parquet(path))
