"""The commits of a consumer: one table of a snapshot and the epochs since, with resets as rows.

Every micro-batch adds one folder, named by its epoch, which a repetition replaces. Each SNAPSHOT_EVERY epochs the
state so far is written as a snapshot, and what it stands for is removed, so a reader opens a bounded
number of files however long the stream has run. Offsets are any texts: they are ordered by reception,
and by number only in partitions where all of them are numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelog.functions.cursors import offset_text
from tidelog.model import ETP
from tidelog.operators.joins import join_null_safe

SNAPSHOT_EVERY = 16
# A commit is a row per partition, so an epoch is small.
FILES = 4

ROWS = (
    "stream_id string, event_type string, partition string, offset bigint, offset_text string,"
    " frame_id bigint, reset boolean, at_epoch bigint"
)


def _files(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def _epochs(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """Finished folders below ``path`` by their epoch."""
    fs, root = _files(spark, path)
    found: dict[int, list[str]] = {}
    for status in fs.listStatus(root) if fs.exists(root) else ():
        folder = status.getPath()
        if fs.exists(_files(spark, f"{folder.toString()}/_SUCCESS")[1]):
            found.setdefault(int(folder.getName().split("=")[1].split("-")[0]), []).append(folder.toString())
    return found


def _paths(spark: SparkSession, out: str) -> tuple[list[str], int]:
    """What makes up the state: the last snapshot, the epochs and the resets since; and the last epoch."""
    snapshots, tails, resets = (_epochs(spark, f"{out}/ledger/{kind}") for kind in ("snapshot", "tail", "reset"))
    last = max(snapshots, default=-1)
    chosen = snapshots.get(last, []) + [p for e, ps in tails.items() if e > last for p in ps]
    # A reset comes after the commits of its epoch, and so after a snapshot of it.
    chosen += [p for e, ps in resets.items() if e >= last for p in ps]
    return chosen, max([last, *tails], default=-1)


def state(spark: SparkSession, out: str) -> DataFrame:
    """One row per partition, as ROWS: what is committed with resets in force."""
    paths, _ = _paths(spark, out)
    rows = spark.read.schema(ROWS).parquet(*paths) if paths else spark.createDataFrame([], ROWS)
    place = F.struct("at_epoch", "reset", "frame_id")
    since = rows.groupBy(*ETP).agg(F.max(F.when(F.col("reset"), place)).alias("_since"))
    valid = join_null_safe(rows, since, ETP).filter(F.col("_since").isNull() | (place >= F.col("_since")))
    numeric = F.bool_and(F.col("offset").isNotNull())
    folded = valid.groupBy(*ETP).agg(
        F.max_by("stream_id", place).alias("stream_id"),
        F.when(numeric, F.max("offset")).alias("offset"),
        F.max_by("offset_text", place).alias("_text"),
        F.max(place).alias("_place"),
    )
    return folded.select(
        "stream_id",
        *ETP,
        "offset",
        F.coalesce(offset_text(F.col("offset")), F.col("_text")).alias("offset_text"),
        F.col("_place.frame_id").alias("frame_id"),
        F.lit(False).alias("reset"),
        F.col("_place.at_epoch").alias("at_epoch"),
    )


def _write(rows: DataFrame, path: str) -> None:
    rows.coalesce(FILES).write.mode("overwrite").parquet(path)


def commit(out: str, epoch: int, cursors: DataFrame) -> None:
    """Record the cursors of an epoch: stream_id, event_type, partition, offset, offset_text, last_frame_id."""
    spark = cursors.sparkSession
    columns = ["stream_id", *ETP, F.col("offset").cast("long").alias("offset"), "offset_text"]
    rows = cursors.select(*columns, F.col("last_frame_id").alias("frame_id"), F.lit(False).alias("reset"))
    _write(rows.withColumn("at_epoch", F.lit(epoch).cast("long")), f"{out}/ledger/tail/epoch={epoch}")
    if epoch % SNAPSHOT_EVERY == SNAPSHOT_EVERY - 1:
        _write(state(spark, out), f"{out}/ledger/snapshot/epoch={epoch}")
        # The last snapshot but one stays, for a reader that has just begun.
        for kind in ("snapshot", "tail", "reset"):
            for old, folders in _epochs(spark, f"{out}/ledger/{kind}").items():
                if old < epoch - SNAPSHOT_EVERY:
                    for folder in folders:
                        fs, path = _files(spark, folder)
                        fs.delete(path, True)


def reset(spark: SparkSession, out: str, to: DataFrame) -> None:
    """Set partitions (event_type, partition, and offset, a text or a number) back or forth, from the next read on."""
    _, last = _paths(spark, out)
    n = len(_epochs(spark, f"{out}/ledger/reset").get(last, []))
    text = F.col("offset").cast("string")
    number = F.when(text == "begin", F.lit(-1).cast("long")).otherwise(text.try_cast("long"))
    none = F.lit(None).cast("string")
    rows = to.select(
        none.alias("stream_id"), *ETP, number.alias("offset"), text.alias("offset_text"), F.lit(n).cast("long").alias("frame_id"),
        F.lit(True).alias("reset"), F.lit(last).cast("long").alias("at_epoch"),
    )
    _write(rows, f"{out}/ledger/reset/epoch={last}-{n}")


def committed(spark: SparkSession, out: str) -> DataFrame:
    """Committed offset per partition, as a number where all offsets are numbers, and as a text."""
    return state(spark, out).select(*ETP, F.col("offset").alias("committed"), F.col("offset_text").alias("committed_text"))
