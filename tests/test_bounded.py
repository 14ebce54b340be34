"""What a task holds at once doesn't grow with the table or with the width of its rows."""

from collections import Counter

from pyspark.sql import functions as F, types as T

from tidelog.operators import segments
from tidelog.plans import queries

SF = "/root/testdata/sf0.001"


def kept_schemas(monkeypatch, module) -> list[T.StructType]:
    """The schemas of the tables that a module stores from now on."""
    seen, store = [], module.stored

    def noting(df, *name):
        seen.append(df.schema)
        return store(df, *name)

    monkeypatch.setattr(module, "stored", noting)
    return seen


def test_chained_cuts_store_no_row_that_holds_a_segment(spark, monkeypatch):
    seen = kept_schemas(monkeypatch, segments)
    df = spark.range(60).select(
        F.lit(None).cast("string").alias("k"), F.col("id").alias("pos"), F.col("id").alias("lvl"), (F.col("id") + 7).alias("lim"), F.lit("x").alias("more")
    )
    got = segments.chained_cuts(df, ["k"], "pos", "lvl", "lim", segment_rows=20)
    assert got.columns == [*df.columns, "piece", "piece_until"]
    assert got.filter("piece <> pos div 7 or piece_until <> pos - pos % 7 + 7 or more <> 'x'").count() == 0 and got.count() == 60
    assert seen and not [f for schema in seen for f in schema if isinstance(f.dataType, T.ArrayType)]


def test_texts_of_frames_do_not_go_through_the_scan(spark, monkeypatch):
    seen = kept_schemas(monkeypatch, segments)
    queries.frame_gaps(spark, SF), queries.batch_gaps(spark, SF), queries.frame_order_per_assignment(spark, SF)
    scanned = [set(schema.names) for schema in seen if "_ends" in schema.names or "frame_id" in schema.names]
    assert len(scanned) >= 4 and not [names for names in scanned if names & {"value", "events", "info"}]


def test_micro_batches_are_written_in_many_files(spark, monkeypatch):
    """As many files in each, read together, so batches are ranges of the order; a range without rows is a batch as well."""
    monkeypatch.setattr(queries, "STREAM_FILE_ROWS", 20, raising=False)
    table = spark.range(600).select("id", F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id")).alias("t")).repartition(8).cache()
    read = []

    def note(batch, _):
        read.append(batch.select("t", F.input_file_name().alias("file")).collect())

    stream = queries._stream_of(table, F.col("t"))
    stream.writeStream.foreachBatch(note).trigger(availableNow=True).start().awaitTermination()
    assert len(read) == queries.STREAM_FILES
    times = [[r["t"] for r in rows] for rows in read]
    assert sorted(t for own in times for t in own) == sorted(r["t"] for r in table.collect())
    filled = [own for own in times if own]
    assert all(max(a) < min(b) for a, b in zip(filled, filled[1:]))
    sizes = Counter(r["file"] for rows in read for r in rows)
    assert max(sizes.values()) <= 150 and any(len({r["file"] for r in rows}) > 1 for rows in read)
