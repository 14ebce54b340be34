"""What each filter removes in every order of the filters, counted by an incremental stream with retractions."""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidelog.llm.common import map_batches
from tidelog.operators.joins import join_shuffled
from tidelog.session import scratch_path, stored

#: The filters; bit k of a mask is set if filter k fails. The last one is given by the state.
FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")
#: Fixed values of the filters A to D.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3
_CAPITALS, _SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
#: Micro-batches that the files of a table are dealt to, at most.
ROUNDS = 4
#: Labels, of 10 bytes each, that are broadcast; more of them are joined by a shuffle, each id in so many parts.
BROADCAST_LABELS, SALTS = 500_000, 16

#: Texts that share one row of the keyed state, about; calls by key cost more than their work.
BUCKET_TEXTS = 2000
_HELD = np.dtype([("key", "V32"), ("least", "<i8"), ("kind", "<i4"), ("n", "<i8")])

_KINDS = ["part", "mask", "good", "toxic"]
_DELTAS = "part string, mask int, good boolean, toxic boolean, n long"
#: A null id counts as larger than all others.
_LAST_ID = (1 << 63) - 1


def failures(text: str) -> int:
    """Mask of the filters A to D that a text fails."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    few = len(words) < LEAST_WORDS
    repetitive = 100 * len(set(words)) < DISTINCT_PERCENT * len(words)
    loud = 100 * (len(data) - len(data.translate(None, _CAPITALS))) > CAPITAL_PERCENT * len(text)
    signs = len(data.translate(None, _SIGNS)) < len(data)
    return few | repetitive << 1 | loud << 2 | signs << 3


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, key, mask): each document's own failures, and the sha256 of its text instead of the text."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)).alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        keys = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in texts]
        masks = pa.array(map(failures, texts), pa.int32())
        columns = [batch.column("doc_id"), batch.column("part"), pa.array(keys, pa.binary()), masks]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "key", "mask"])

    return map_batches(rows, step, "doc_id long, part string, key binary, mask int")


def labelled(rows: DataFrame, labels: DataFrame, broadcast_labels: int = BROADCAST_LABELS) -> DataFrame:
    """``rows`` with good (quality 1) and toxic (toxic 1); a repeated label counts if any of its rows says so.

    An id may hold any share of the rows: where labels are too many to be broadcast, each id is dealt to SALTS
    parts, and rows without an id go anywhere. Then nothing is broadcast: labels of sequential ids take few bytes
    in files, and Spark doesn't count what SALTS multiplies.
    """
    one = F.coalesce(F.max(F.col("quality") == 1), F.lit(False)), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = stored(known.agg(one[0].alias("good"), one[1].alias("toxic")).where("good or toxic"), "labels")
    if known.count() <= broadcast_labels:
        joined = rows.join(F.broadcast(known), "doc_id", "left")
    else:
        spread = F.xxhash64("key")
        salt = F.when(F.col("doc_id") == _LAST_ID, spread).otherwise(F.pmod(spread, F.lit(SALTS)))
        parts = known.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        joined = join_shuffled(rows.withColumn("salt", salt), parts, ["doc_id", "salt"], "left")
    good, toxic = (F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic"))
    return joined.select("doc_id", "part", "key", "mask", good, toxic)


def folded(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows of one Arrow batch folded before the shuffle, so that a text of very many rows has few of them.

    Of equal texts in a batch only those of the smallest id are candidates for the state; the others certainly
    repeat a smaller id's text. They are counted here and pass under a short key, which has no state. The
    leading bytes of the key deal the texts to ``buckets``.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [batch.column(c).to_pylist() for c in ("key", "doc_id", *_KINDS)]
        least: dict[bytes, int] = {}
        for key, doc_id in zip(*columns[:2], strict=True):
            if doc_id < least.get(key, doc_id + 1):
                least[key] = doc_id
        counts: Counter = Counter()
        for key, doc_id, part, mask, good, toxic in zip(*columns, strict=True):
            if doc_id == least[key]:
                counts[key, doc_id, part, mask, good, toxic] += 1
            else:
                counts[columns[0][0][:1], 0, part, mask | REPEATED, good, toxic] += 1
        made = [*zip(*counts, strict=True)] or [()] * 6
        kinds = (pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.bool_())
        arrays = [pa.array(c, k) for c, k in zip(made, kinds, strict=True)]
        dealt = [int.from_bytes(key[:8], "big") % buckets for key in made[0]]
        columns = [pa.array(dealt, pa.int64()), *arrays, pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "key", "doc_id", *_KINDS, "n"])

    return map_batches(rows, step, f"bucket long, key binary, doc_id long, {_DELTAS}")


def _load(state: GroupState) -> dict[bytes, tuple[int, dict]]:
    """Of each text of the bucket: the smallest id so far, and what its rows were counted as."""
    held: dict[bytes, tuple[int, dict]] = {}
    if state.exists:
        texts, names = state.get
        kinds = [tuple(k) for k in json.loads(names)]
        for key, least, kind, n in np.frombuffer(texts, _HELD).tolist():
            held.setdefault(key, (least, {}))[1][kinds[kind]] = n
    return held


def _keep(state: GroupState, held: dict[bytes, tuple[int, dict]]) -> None:
    kinds = {kind: k for k, kind in enumerate(dict.fromkeys(kind for _, own in held.values() for kind in own))}
    rows = [(key, least, kinds[kind], n) for key, (least, own) in held.items() for kind, n in own.items()]
    state.update((np.array(rows, _HELD).tobytes(), json.dumps([*kinds])))


def settle(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Changes of the counters by the new rows of the texts of one bucket.

    When a smaller id of a text comes, what the rows of the smallest id so far were counted as is taken back
    and given again as repeated.
    """
    changes: Counter = Counter()
    held = _load(state)
    for frame in frames:
        columns = [frame[c].tolist() for c in ("key", "doc_id", *_KINDS, "n")]
        for key, doc_id, part, mask, good, toxic, n in zip(*columns, strict=True):
            kind = (part, mask, good, toxic)
            if len(key) == 1:
                changes[kind] += n
                continue
            least, own = held.get(key, (doc_id, {}))
            if doc_id > least:
                changes[part, mask | REPEATED, good, toxic] += n
                continue
            if doc_id < least:
                for (was, bits, a, b), count in own.items():
                    changes[was, bits, a, b] -= count
                    changes[was, bits | REPEATED, a, b] += count
                own = {}
            own[kind] = own.get(kind, 0) + n
            held[key] = (doc_id, own)
            changes[kind] += n
    _keep(state, held)
    rows = [(*kind, n) for kind, n in changes.items() if n]
    yield pd.DataFrame(rows, columns=[*_KINDS, "n"])


def _buckets(spark: SparkSession, path: str, folder: str, bucket_texts: int) -> int:
    """The number of buckets, which stays that of the first run in ``folder``."""
    try:
        return spark.read.parquet(f"{folder}/buckets").first()[0]
    except AnalysisException:
        n = spark.read.parquet(path).count() // bucket_texts + 1
        spark.createDataFrame([(n,)], "buckets long").write.parquet(f"{folder}/buckets")
        return n


def counters(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    *,
    rounds: int = ROUNDS,
    folder: str | None = None,
    broadcast_labels: int = BROADCAST_LABELS,
    bucket_texts: int = BUCKET_TEXTS,
) -> DataFrame:
    """(part, mask, n, n_good, n_toxic): documents of the Parquet table at ``path`` by part and failed filters.

    The files are a stream, read in ``rounds`` micro-batches at most that are available now. A keyed state
    knows the smallest id of every text; texts share a row of it in buckets of about ``bucket_texts``, whose number
    follows from that of the rows when the stream begins. Each micro-batch adds its changes to the counters as one folder, named by its number and
    replaced as a whole, so a batch that is run again after a failure counts once. ``folder`` (in storage that
    all executors share) keeps the checkpoint; with the same one a later run goes on where the last one stopped
    and also takes files that came meanwhile.
    """
    folder = folder or scratch_path(spark, "filter-audit")
    n_files = spark.read.format("binaryFile").load(path).select("length").count()
    # A pattern that fits the path alone: a stream doesn't take a single file otherwise.
    exact = f"{path[:-1]}[{path[-1]}]"
    schema = spark.read.parquet(path).select("doc_id", "lang", "text").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max(1, -(-n_files // rounds))).parquet(exact)
    rows = folded(labelled(judged(stream), labels, broadcast_labels), _buckets(spark, path, folder, bucket_texts))
    changes = rows.groupBy("bucket").applyInPandasWithState(
        settle, _DELTAS, "texts binary, kinds string", "append", GroupStateTimeout.NoTimeout
    )

    def add(batch: DataFrame, batch_id: int) -> None:
        total = batch.groupBy(*_KINDS).agg(F.sum("n").alias("n"))
        total.write.mode("overwrite").parquet(f"{folder}/counters/batch={batch_id}")

    # So that there is something to read where no file has a row.
    spark.createDataFrame([], _DELTAS).write.mode("overwrite").parquet(f"{folder}/counters/batch=-1")
    writer = changes.writeStream.foreachBatch(add).outputMode("append").trigger(availableNow=True)
    writer.option("checkpointLocation", f"{folder}/checkpoint").start().awaitTermination()
    found = spark.read.schema(_DELTAS).parquet(f"{folder}/counters")
    sums = [F.sum("n").alias("n"), *(F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(f"n_{c}") for c in ("good", "toxic"))]
    return found.groupBy("part", "mask").agg(*sums).where("n > 0")


def report(counted: DataFrame) -> DataFrame:
    """One row per part, order of the filters, and step, from :func:`counters`.

    A part has 32 masks at most, so every row here is a sum of 32 counters at most, whatever the table holds.
    """
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    steps = counted.select("*", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")
    )
    bit = "shiftleft(1, ascii(substr(filter_order, {}, 1)) - ascii('A'))".format
    before = F.expr(f"aggregate(sequence(1, {len(FILTERS)}), 0, (bits, k) -> bits + if(k < step, {bit('k')}, 0))")
    steps = steps.withColumn("own", F.expr(bit("step"))).withColumn("before", before)
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    reached = F.col("mask").bitwiseAND(F.col("before")) == 0
    alone = F.col("mask") == F.col("own")
    # Of a document's failing filters each comes first in equally many orders.
    share = (F.lit(len(list(permutations(FILTERS)))) / F.bit_count("mask")).cast("long")

    def total(when: Column, of: Column | str) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(of) if isinstance(of, str) else of)), F.lit(0)).cast("long")

    return steps.groupBy("part", "filter_order", "step").agg(
        total(reached & ~fails, "n").alias("kept"),
        total(reached & fails, "n").alias("removed"),
        total(~reached & fails, "n").alias("redundant"),
        total(alone, "n").alias("unique_fails"),
        total(reached & fails, "n_good").alias("good_lost"),
        total(reached & fails, "n_toxic").alias("toxic_lost"),
        total(fails, F.col("n") * share).alias("shapley"),
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, **options) -> DataFrame:
    """How the filters A to E interact on the documents (doc_id, lang, text) at ``path``; see the columns of :func:`report`.

    A null text is empty, a null lang the part of the empty string. Texts are taken whole; equal texts are equal
    in all bytes (by sha256). E fails where a smaller doc_id has the same text; rows of the same smallest id all
    pass it, and a null id counts as larger than all others. Repeated rows count as often as they occur. Other
    columns, of any name, aren't read. An empty table has no parts and gives no rows. ``options`` are those of
    :func:`counters`.
    """
    return report(counters(spark, path, labels, **options))
