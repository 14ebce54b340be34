"""Exact duplicates through an extendible-hash index on shared files. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.common import id_and_text
from tidelog.operators.joins import join_small
from tidelog.session import stored

#: Distinct texts a bucket may hold before it is split.
BUCKET_ENTRIES = 4096
#: Directory bits beyond the even spread, for buckets that have to be split further than others.
SPARE_BITS = 4
#: Parts in which the copies of one text are folded before the owner of their bucket gets them.
FOLDS = 16
#: A text is hot if more than one row in so many has it; so there are fewer hot texts than this.
HOT_SHARE = 1000


def normalised(text: Column) -> Column:
    """Each run of blanks, tabs and line ends as one blank."""
    return F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", " ")


@dataclass(frozen=True)
class HashIndex:
    """``directory``: slot, bucket, depth. ``entries``: bucket, key, chain_pos, chain_len, keep_id, n_rows, sha256 and,
    where texts share a key, text; one for each distinct text, the whole of a bucket in one file."""

    directory: DataFrame
    entries: DataFrame
    directory_bits: int
    n_rows: int

    def placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the bucket in which the directory has the slot of their ``key``."""
        slots = self.directory.select("slot", "bucket")
        found = rows.withColumn("slot", _slot(F.col("key"), self.directory_bits))
        return join_small(found, slots, ["slot"], n_rows=slots.count()).drop("slot")

    def met(self, rows: DataFrame, entries: DataFrame, on: list[str]) -> DataFrame:
        """``rows`` with their entry; rows of hot texts meet theirs where they lie."""
        is_hot = F.col("n_rows") * HOT_SHARE > self.n_rows
        # Fewer than HOT_SHARE rows.
        hot = F.broadcast(entries.where(is_hot))
        others = rows.join(hot.select(*on), on, "left_anti")
        return rows.join(hot, on).unionByName(others.join(entries.where(~is_hot), on))


def _slot(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def build_directory(keys: DataFrame, n_keys: int, bucket_entries: int = BUCKET_ENTRIES) -> tuple[DataFrame, int]:
    """Directory over the leading bits of ``key``: one row per slot with its bucket and the bucket's local depth.

    It starts with one bucket. As long as a bucket holds more than ``bucket_entries`` keys it is split by one
    more bit, doubling the directory where the bucket already used all its bits. All rounds work on a histogram
    of at most ``2 ** SPARE_BITS * 2 * n_keys / bucket_entries`` slots, never on the keys again.
    """
    bits = min(60, max(0, (max(n_keys, 1) - 1) // bucket_entries).bit_length() + SPARE_BITS)
    slots = stored(keys.groupBy(_slot(F.col("key"), bits).alias("slot")).agg(F.count("*").alias("n")), "slots")
    pending, done = slots, None
    for depth in range(bits + 1):
        prefix = F.shiftright("slot", bits - depth)
        held = pending.groupBy(prefix.alias("prefix")).agg(F.sum("n").alias("held"))
        placed = pending.withColumn("prefix", prefix).join(held, "prefix")
        placed = stored(
            placed.select(
                "slot",
                "n",
                (F.col("held") > bucket_entries).alias("over"),
                F.shiftleft("prefix", bits - depth).alias("bucket"),
                F.lit(depth).alias("depth"),
            ),
            "placed",
        )
        fits = placed if depth == bits else placed.where("not over")
        fits = fits.select("slot", "bucket", "depth")
        done = fits if done is None else done.unionByName(fits)
        pending = placed.where("over").select("slot", "n")
        if depth == bits or pending.isEmpty():
            break
    return stored(done, "directory"), bits


def build_index(rows: DataFrame, keys: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> HashIndex:
    """Index the distinct texts of ``rows`` (doc_id, text, key); ``keys`` has the (doc_id, key) of all rows.

    The directory is made from the distinct keys. Copies are folded by the tasks that read them, and in ``FOLDS`` parts
    by a shuffle, so that a text that fills a third of the table reaches its owner as a few rows. The directory
    deals the folded texts to the owners of their buckets; an owner chains the texts under a key, whole texts compared.
    """
    distinct = stored(keys.select("key").distinct(), "distinct")
    directory, bits = build_directory(distinct, distinct.count(), bucket_entries)
    index = HashIndex(directory, distinct, bits, keys.count())
    merged = (F.min("keep_id").alias("keep_id"), F.sum("n_rows").alias("n_rows"))
    folds = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).alias("fold")
    folded = rows.groupBy(folds, "key", "text").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n_rows"))
    # What an owner does needs no shuffle of its own: whole buckets are in one task.
    owned = index.placed(folded).repartition("bucket").groupBy("bucket", "key", "text").agg(*merged)
    chain = Window.partitionBy("bucket", "key")
    place = F.row_number().over(chain.orderBy(F.col("keep_id").asc_nulls_last(), "text"))
    entries = owned.select(
        "bucket",
        "key",
        place.alias("chain_pos"),
        F.count("*").over(chain).alias("chain_len"),
        "keep_id",
        "n_rows",
        F.sha2("text", 256).alias("sha256"),
        "text",
    ).withColumn("text", F.when(F.col("chain_len") > 1, F.col("text")))
    return HashIndex(directory, stored(entries, "index"), bits, index.n_rows)


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    bucket_entries: int = BUCKET_ENTRIES,
    key_bits: int = 64,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Texts are equal when they are identical after :func:`normalised`; null counts as empty. ``keep_id`` is the
    smallest doc_id of the equal texts (null ids only where all are null), and every row that carries it is
    kept, so repeated rows with the same id and text stay together. An empty table gives an empty result.
    A row finds its entry by the slot of its key, the bucket the directory has for it, and the chain of the key there.
    ``key_bits`` shortens the hash, for tests of the collision chains; results don't depend on it.
    """
    text = normalised(F.col("text"))
    key = F.xxhash64("text")
    rows = id_and_text(docs, id_col, text_col).select("doc_id", text.alias("text"))
    rows = rows.withColumn("key", F.shiftrightunsigned(key, 64 - key_bits) if key_bits < 64 else key)
    keys = stored(rows.select("doc_id", "key"), "keys")
    index = build_index(rows, keys, bucket_entries)
    answer = ["bucket", "key", "keep_id", "n_rows", "sha256"]
    alone = index.entries.where("chain_len = 1").select(*answer)
    found = index.met(index.placed(keys), alone, ["bucket", "key"])
    chained = index.entries.where("chain_len > 1")
    if not chained.isEmpty():
        # Several texts under one key: the row's own text finds its place in the chain.
        found = found.unionByName(index.met(index.placed(rows), chained.select(*answer, "text"), ["bucket", "key", "text"]).drop("text"))
    return found.select(
        "doc_id",
        "keep_id",
        F.col("n_rows").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )
