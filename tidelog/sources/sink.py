"""Publish sink: judged events into the log, responses back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelog.model import ETP
from tidelog.operators.publishing import with_status
from tidelog.model import SUBMITTED
from tidelog.sources.log import READ_SALTS


def submitted_rows(judged: DataFrame) -> DataFrame:
    """What of judged events goes into the log: the submitted ones, by their metadata."""
    meta = F.col("metadata")
    return with_status(judged, SUBMITTED).select(
        meta["event_type"].alias("event_type"),
        meta["partition"].alias("partition"),
        "batch_id",
        "pos",
        meta["eid"].alias("eid"),
        meta["occurred_at"].alias("occurred_at"),
        meta["received_at"].alias("received_at"),
        F.col("event").alias("payload"),
    )


def publish(judged: DataFrame, path: str, attempt: int = 0, salts: int = READ_SALTS) -> DataFrame:
    """Write the submitted events and return the responses.

    Each attempt has its own folder, replaced as a whole, so a repeated attempt does not
    write events twice.
    """
    rows = submitted_rows(judged).withColumn("_salt", F.pmod(F.xxhash64("eid"), F.lit(salts)))
    (
        rows.repartition(*ETP, "_salt")
        .drop("_salt")
        .write.mode("overwrite")
        .partitionBy(*ETP)
        .parquet(f"{path}/attempt={attempt}")
    )
    return judged.select(
        "batch_id", "pos", F.col("metadata.eid").alias("eid"), "publishing_status", "step", "detail", "code"
    )


def published(spark: SparkSession, path: str) -> DataFrame:
    """Everything that was published below ``path``."""
    return spark.read.option("basePath", path).parquet(f"{path}/attempt=*").withColumn(
        "partition", F.col("partition").cast("string")
    )
