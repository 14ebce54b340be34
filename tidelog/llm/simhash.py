"""Near duplicates by SimHash fingerprints, linked through a multi-index hash table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidelog.llm.common import components, id_and_text, map_batches
from tidelog.operators.joins import join_shuffled
from tidelog.session import stored

#: Words of a shingle and differing bits of a link. The two 32-bit segments below fit up to 2 bits.
SHINGLE, MAX_BITS = 3, 2
SEED = 42
#: A bucket with more fingerprints than this isn't paired but linked through shared neighbours.
BUCKET = 16

#: Bit i of a byte as byte i of a word, to count bits of many hashes by adding words.
_SPREAD = np.array([sum((b >> i & 1) << 8 * i for i in range(8)) for b in range(256)], np.uint64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


#: The Hamming balls of radius 1, as masks: of a segment of 32 bits, and of a whole fingerprint.
SEGMENT_BALL = [0, *(1 << i for i in range(32))]
FULL_BALL = [0, *(_signed(1 << i) for i in range(64))]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles, repeats included; unsigned. Zero without words."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined, n = b" ".join(found), len(found)
    if n <= shingle:
        return xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, found), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    spans = zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
    # In groups of 255 a byte can't overflow.
    sums = np.add.reduceat(_SPREAD[hashes.view(np.uint8).reshape(-1, 8)], np.arange(0, len(hashes), 255), axis=0)
    ones = sums.astype("<u8").view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of every document as a signed long."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [_signed(fingerprint(t, shingle)) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return map_batches(id_and_text(docs, id_col, text_col), step, "doc_id long, fp long")


def near_links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` that have the components of all pairs at 2 bits or fewer.

    Of two such fingerprints, either the high halves differ in at most one bit or the low halves are equal. The
    index has a table for each half. A fingerprint looks up the ball of radius 1 around its high half and its
    low half itself; what it meets is verified by all 64 bits. Fingerprints that meet a bucket of more than
    ``bucket`` entries aren't paired there: each writes itself under all values within one bit of it, and those
    under the same value, which are at most 2 bits apart, are linked to the smallest. Two fingerprints share
    a value exactly if they are 2 bits apart or fewer, so no link is lost, at 65 rows each and without pairs.
    The balls have 33 and 65 rows a fingerprint, which Spark's estimates leave out, so neither side is broadcast there.
    """
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    masks = F.array(*(F.lit(m).cast("long") for m in SEGMENT_BALL))
    probes = fps.select("fp", F.explode(F.transform(masks, lambda m: high.bitwiseXOR(m))).alias("value"), F.lit(0).alias("half"))
    probes = probes.unionByName(fps.select("fp", low.alias("value"), F.lit(1).alias("half")))
    table = fps.select(F.lit(0).alias("half"), high.alias("value"), F.col("fp").alias("met")).unionByName(
        fps.select(F.lit(1).alias("half"), low.alias("value"), F.col("fp").alias("met"))
    )
    sizes = table.groupBy("half", "value").agg(F.count("*").alias("n"))
    full = stored(sizes.where(F.col("n") > bucket).select("half", "value"), "full-buckets")
    some_full = not full.isEmpty()
    open_table = table.join(full, ["half", "value"], "left_anti") if some_full else table
    far = F.bit_count(F.col("fp").bitwiseXOR(F.col("met")))
    links = (
        join_shuffled(probes, open_table, ["half", "value"])
        .where((F.col("fp") < F.col("met")) & (far <= MAX_BITS))
        .select(F.col("fp").alias("a"), F.col("met").alias("b"))
    )
    if some_full:
        meeting = stored(probes.join(full, ["half", "value"], "left_semi").select("fp").distinct(), "meeting")
        balls = F.array(*(F.lit(m).cast("long") for m in FULL_BALL))
        around = meeting.select("fp", F.explode(F.transform(balls, lambda m: F.col("fp").bitwiseXOR(m))).alias("value"))
        least = around.groupBy("value").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
        stars = join_shuffled(around, least, ["value"]).where("fp <> a").select("a", F.col("fp").alias("b"))
        links = links.unionByName(stars)
    return links.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, bucket: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest doc_id that links of 2 bits or fewer reach; null ids count as larger than
    all others. A text without words, null or empty, has fingerprint zero and is linked like any other. An
    empty table gives no rows; repeated rows are answered one by one.
    """
    marked = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(near_links(classes.select("fp"), bucket), "near-links")
    reached = classes.join(roots.withColumnRenamed("node", "fp"), "fp")
    least = reached.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = reached.join(least, "root").select("fp", "component_id")
    answers = classes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return marked.join(answers, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
