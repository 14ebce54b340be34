"""The index of exact duplicates: rows are answered through its directory, and hot texts are joined in place."""

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidelog.llm import exact_dedup

ROWS = [(i, f"text {i % 400}") for i in range(900)] + [(2000 + i, "of a third") for i in range(500)] + [(None, "text 1"), (7, None), (7, " ")]


def answers(found):
    return sorted(map(tuple, found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.mark.parametrize("hot_share", [1, 3, 100_000])
@pytest.mark.parametrize("key_bits", [64, 3])
def test_hot_texts(spark, monkeypatch, hot_share, key_bits):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", hot_share)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = answers(exact_dedup.exact_duplicates(docs, bucket_entries=20, key_bits=key_bits))
    assert got == sorted(brute.exact(ROWS), key=repr)


def test_a_wrong_directory_is_noticed(spark, monkeypatch):
    """Entries dealt by one directory aren't found through another."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    right, build = exact_dedup.HashIndex, exact_dedup.build_index

    def wrong(rows, keys, bucket_entries):
        index = build(rows, keys, bucket_entries)
        shifted = index.directory.withColumn("bucket", F.when(F.col("bucket") == 0, F.col("bucket")).otherwise(F.col("bucket") + 1))
        return right(shifted, index.entries, index.directory_bits, index.n_rows)

    monkeypatch.setattr(exact_dedup, "build_index", wrong)
    got = answers(exact_dedup.exact_duplicates(docs, bucket_entries=20))
    assert 0 < len(got) < len(ROWS)


def test_buckets_are_whole_and_small(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    index = exact_dedup.build_index(rows, rows.select("doc_id", "key"), 20)
    entries = index.entries.withColumn("file", F.input_file_name())
    held = entries.groupBy("bucket").agg(F.count("*").alias("n"), F.countDistinct("file").alias("files")).collect()
    assert len(held) > 10 and max(r["n"] for r in held) <= 20 and {r["files"] for r in held} == {1}
    assert {r["depth"] for r in index.directory.collect()} - {0}
