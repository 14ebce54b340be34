"""From raw documents to tokens: quality, exact and near duplicates, benchmark passages, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import bpe, decontaminate, exact_dedup, quality, simhash
from tidelog.llm.common import ROW, keyed, without_rows
from tidelog.llm.queries import VOCABULARIES, benchmark, labels
from tidelog.session import scratch_path


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier doesn't reject; it is fitted on the labelled documents among ``docs``."""
    return quality.good_rows(docs, quality.train(docs, labels(spark, sf_dir)))


def first_of_each(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """One row of each group (``groups`` names that of every row key): the smallest doc_id, of equal ids the first row."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", ROW)
    members = groups.join(rows.select(ROW, "doc_id"), ROW)
    best = members.groupBy("group").agg(F.min(order).alias("best"), F.count("*").alias("n")).where("n > 1")
    return without_rows(rows, members.join(best, "group").where(F.col(ROW) != F.col(f"best.{ROW}")).select(ROW))


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: that of the smallest doc_id, of equal ids the first row."""
    rows = keyed(docs)
    groups = exact_dedup.exact_duplicates(rows, ROW).select(F.col("doc_id").alias(ROW), F.col("keep_id").alias("group"))
    return first_of_each(rows, groups)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that SimHash links: that of the smallest doc_id, of equal ids the first row.

    Texts without words, null or empty, have one fingerprint and so are one group.
    """
    rows = keyed(docs)
    linked = simhash.near_duplicates(rows, ROW)
    return first_of_each(rows, linked.select(F.col("doc_id").alias(ROW), F.col("component_id").alias("group")))


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a window of a benchmark item."""
    rows = keyed(docs)
    judged = decontaminate.contaminated(rows, benchmark(spark, sf_dir), ROW)
    return without_rows(rows, judged.where("contaminated").select("doc_id"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the tokens of each document, and digest of the decoded text."""
    # Workers that other stages have used share the executor's memory with a heap that has grown.
    return bpe.encode(docs, f"{VOCABULARIES}/word_bpe_49k.json", keep_text=False, remembered=100_000)


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", first_copies),
    ("near_dedup", distinct_documents),
    ("decontamination", clean_documents),
    ("bpe", tokens),
]

#: The first stage is a learned classifier, which SQL can't express; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each keeps is written to the shared folder for the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
