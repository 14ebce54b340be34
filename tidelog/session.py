"""Session helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "tidelog", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only where the cluster names none (tests, a laptop) a local folder is made; it goes
    with the process. On a cluster the folder belongs to its owner, who clears it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        made = tempfile.mkdtemp(prefix="tidelog-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", made)
        return made
    raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid4().hex}"


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and survives the loss of executors; used where a table is
    read several times by an iterative job.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
