"""Benchmark passages in documents, found through a positional inverted index."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.common import Rows, id_and_text, map_batches, release_memory
from tidelog.session import stored

#: Words of a window.
WINDOW = 10
#: Characters of benchmark text whose words and windows are handed to all tasks at once; more go in blocks.
BLOCK_CHARS = 16_000_000

#: Separators become blanks and A-Z become a-z; words are what lies between blanks.
_FOLD = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)

_POSTINGS = "row_id long, doc_id long, n_words long, term int, pos int, near array<int>"


def words(text: str | None) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _terms(text: str, vocabulary: dict[bytes, int]) -> np.ndarray:
    """Term numbers of the words; -1 for words that no item has."""
    found = words(text)
    return np.fromiter(map(vocabulary.get, found, repeat(-1)), np.int32, len(found))


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """How often each item word occurs in the corpus: (term, n). Counted per batch before the shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = shared.value
        total = np.zeros(len(known) + 1, np.int64)
        for text in batch.column("text").to_pylist():
            total += np.bincount(_terms(text, known) + 1, minlength=len(total))
        terms = np.flatnonzero(total[1:])
        return pa.RecordBatch.from_arrays([pa.array(terms.astype(np.int32)), pa.array(total[1:][terms])], ["term", "n"])

    return map_batches(docs.select("text"), count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))


def postings(docs: DataFrame, vocabulary: dict[bytes, int], terms: set[int], reach: int = WINDOW) -> DataFrame:
    """The positional index of ``terms``: one row for each of their tokens in any document.

    A posting has the document's row_id, the position, and the terms within ``reach - 1`` words of it (-1: a
    word of no item, -2: outside the document). Each document also has one row with term -1 and its number of
    words. ``row_id`` tells repeated doc_ids apart; it holds for this DataFrame once it is stored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (vocabulary, np.isin(np.arange(-1, len(vocabulary)), np.fromiter(terms, np.int64, len(terms))))
    )
    around = np.arange(1 - reach, reach)

    def run(batches: Rows) -> Rows:
        try:
            yield from index(batches)
        finally:
            release_memory()

    def index(batches: Rows) -> Rows:
        known, wanted = shared.value
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            parts = []
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, batch.column("text").to_pylist(), strict=True):
                got = _terms(text, known)
                at = np.flatnonzero(wanted[got + 1]).astype(np.int32)
                padded = np.full(len(got) + 2 * reach - 2, -2, np.int32)
                padded[reach - 1 : reach - 1 + len(got)] = got
                near = padded[(at[:, None] + around + reach - 1)]
                parts.append((row, doc_id, len(got), at, got[at], near.reshape(-1)))
                row += 1
            each = [len(p[3]) + 1 for p in parts]
            none = np.array([-1], np.int32)
            flat = np.concatenate([p[5] for p in parts]) if parts else np.zeros(0, np.int32)
            sizes = np.full(sum(each), 2 * reach - 1, np.int32)
            sizes[np.cumsum([0, *each[:-1]])] = 0
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([p[0] for p in parts], each), pa.int64()),
                    pa.array(pd.Series([p[1] for p in parts], dtype="Int64").repeat(each), pa.int64()),
                    pa.array(np.repeat([p[2] for p in parts], each), pa.int64()),
                    pa.array(np.concatenate([x for p in parts for x in (none, p[4])] or [none[:0]]), pa.int32()),
                    pa.array(np.concatenate([x for p in parts for x in (none, p[3])] or [none[:0]]), pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                ["row_id", "doc_id", "n_words", "term", "pos", "near"],
            )

    return docs.mapInArrow(run, _POSTINGS)


def _windows(items: list[tuple], vocabulary: dict[bytes, int], size: int) -> dict[tuple[int, ...], set]:
    """The distinct windows, as term numbers, with the ids of the items that have them."""
    found: dict[tuple[int, ...], set] = {}
    for item_id, text in items:
        got = [vocabulary[w] for w in words(text)]
        for i in range(max(1, len(got) - size + 1) if got else 0):
            found.setdefault(tuple(got[i : i + size]), set()).add(item_id)
    return found


def _rarest(window: tuple[int, ...], counts: dict[int, int]) -> list[int]:
    """Offsets of the two rarest terms at different places (one for a window of one word)."""
    return sorted(range(len(window)), key=lambda i: (counts[window[i]], i))[:2]


def _phrases(index: DataFrame, windows: list[tuple[int, ...]], counts: dict[int, int]) -> DataFrame:
    """(row_id, win, start, n): exact occurrences of the windows.

    The posting lists of a window's two rarest terms, each moved back by the term's offset, are joined on
    (window, document, start); what is in both is compared word by word.
    """
    spark = index.sparkSession
    anchors = [[], []]
    for win, window in enumerate(windows):
        for rank, at in enumerate(_rarest(window, counts)):
            anchors[rank].append((win, window[at], at, len(window), list(window)))
    schema = "win int, term int, at int, n int, window array<int>"
    # Bounded by BLOCK_CHARS, as are the windows.
    first, second = (F.broadcast(spark.createDataFrame(a, schema)) for a in anchors)
    reach = F.expr("cast((size(near) + 1) / 2 as int)")
    starts = [
        index.where("term >= 0").join(side, "term").withColumn("start", F.col("pos") - F.col("at"))
        for side in (first, second)
    ]
    candidates = starts[0].where("start >= 0 and start + n <= n_words")
    key = ["win", "row_id", "start"]
    both = candidates.where("n > 1").join(starts[1].select(*key), key, "left_semi")
    return (
        both.unionByName(candidates.where("n = 1"))
        .where(F.slice("near", reach - F.col("at"), F.col("n")) == F.col("window"))
        .select("row_id", "win", "start", "n")
    )


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``block_chars`` characters, one in the driver at a time."""
    chars = items.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    n = int(chars // block_chars) + 1
    for k in range(n):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()]


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def _matches(docs: DataFrame, benchmark: DataFrame, size: int, block_chars: int) -> tuple[DataFrame, DataFrame]:
    """(row_id, doc_id, n_words) of all documents, and (row_id, start, n, item_id) of all occurrences."""
    spark, lengths, hits = docs.sparkSession, None, None
    for block in _blocks(_items(benchmark), block_chars):
        vocabulary = {w: i for i, w in enumerate(sorted({w for _, text in block for w in words(text)}))}
        counted = {r["term"]: r["n"] for r in term_counts(docs, vocabulary).toLocalIterator()} if vocabulary else {}
        found = _windows(block, vocabulary, size)
        windows = sorted(w for w in found if all(t in counted for t in w))
        anchors = {w[i] for w in windows for i in _rarest(w, counted)}
        index = stored(postings(docs, vocabulary, anchors, size), "postings")
        if lengths is None:
            lengths = index.where("term = -1").select("row_id", "doc_id", "n_words")
        owners = [(k, i) for k, w in enumerate(windows) for i in sorted(found[w], key=lambda x: (x is None, x))]
        owners = F.broadcast(spark.createDataFrame(owners, "win int, item_id string"))
        own = _phrases(index, windows, counted).join(owners, "win").select("row_id", "start", "n", "item_id")
        hits = own if hits is None else hits.unionByName(own)
    return lengths, stored(hits, "matches")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit inside any occurrence of ``window`` consecutive words of an item (of a whole item, if it is
    shorter). Null texts have no words; items without words match nothing; an item without an id makes hits
    but isn't listed. Repeated doc_ids are judged row by row. Empty tables give no rows, or no hits.
    """
    lengths, hits = _matches(id_and_text(docs, id_col, text_col), benchmark, window, block_chars)
    before = Window.partitionBy("row_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.groupBy("row_id", "start").agg((F.col("start") + F.max("n")).alias("end"))
    covered = F.col("end") - F.greatest(F.col("start"), F.least(F.coalesce(F.max("end").over(before), F.lit(0)), "end"))
    n_hit = spans.withColumn("new", covered).groupBy("row_id").agg(F.sum("new").alias("n_hit"))
    items = (
        hits.select("row_id", "item_id").distinct().groupBy("row_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    listed = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    n = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return (
        lengths.join(n_hit.join(items, "row_id"), "row_id", "left")
        .select(
            "doc_id",
            "n_words",
            n.alias("n_hit"),
            F.size(listed).cast("long").alias("n_items"),
            F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
            (n > 0).alias("contaminated"),
        )
    )


def proximity(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    slop: int = 20,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(doc_id, item_id, pos_a, pos_b): places where the two rarest words of an item stand within ``slop`` words.

    The posting lists of both words are joined on document and place, dealt into cells of ``slop`` words;
    a word is looked for in its own and the neighbouring cells. Items of fewer than two different words have none.
    """
    docs = id_and_text(docs, id_col, text_col)
    spark, result = docs.sparkSession, None
    for block in _blocks(_items(benchmark), block_chars):
        vocabulary = {w: i for i, w in enumerate(sorted({w for _, text in block for w in words(text)}))}
        counted = {r["term"]: r["n"] for r in term_counts(docs, vocabulary).toLocalIterator()} if vocabulary else {}
        pairs = []
        for item_id, text in block:
            known = Counter(vocabulary[w] for w in words(text))
            rare = sorted((t for t in known if t in counted), key=lambda t: (counted[t], t))[:2]
            pairs += [(item_id, *rare)] if len(rare) == 2 else []
        index = stored(postings(docs, vocabulary, {t for p in pairs for t in p[1:]}, 1), "postings")
        index = index.where("term >= 0").select("row_id", "doc_id", "term", "pos", F.expr(f"pos div {slop}").alias("cell"))
        sides = F.broadcast(spark.createDataFrame(pairs, "item_id string, a int, b int"))
        a = index.join(sides, F.col("term") == F.col("a")).select("row_id", "doc_id", "item_id", F.col("pos").alias("pos_a"), F.explode(F.array(F.col("cell") - 1, "cell", F.col("cell") + 1)).alias("cell"))
        b = index.join(sides, F.col("term") == F.col("b")).select("row_id", "item_id", F.col("pos").alias("pos_b"), "cell")
        near = a.join(b, ["row_id", "item_id", "cell"]).where(F.abs(F.col("pos_a") - F.col("pos_b")) <= slop)
        near = near.select("doc_id", "item_id", "pos_a", "pos_b")
        result = near if result is None else result.unionByName(near)
    return result
