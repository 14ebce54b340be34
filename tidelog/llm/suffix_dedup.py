"""Removal of passages that occur in a smaller document, by longest previous factors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import id_and_text

#: Bytes of a passage.
MIN_BYTES = 50
#: Bytes of an anchor. Any passage has an anchor inside, chosen by its content alone.
GRAM = 24
#: Text of a group of documents, and anchors of a bucket, about.
GROUP_BYTES, BUCKET_ANCHORS = 8_000_000, 1_000_000
#: An anchor of about so many runs is hot: its passages are dealt to buckets by their own bytes.
HOT_RUNS = 50_000
#: Passages brought into suffix order at a time, about.
PASSAGES = 500_000
#: Documents are laid end to end in pieces of about this size to find their anchors.
_PIECE = 1_000_000
#: Null ids come after all others.
_LAST = np.iinfo(np.int64).max
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full((2, n + 1), 1, np.uint64)
    up[1:], down[1:] = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    got, size = x, 1
    while 2 * size <= width:
        got, size = np.minimum(got[:-size], got[size:]), 2 * size
    return got if size == width else np.minimum(got[: len(got) - (width - size)], got[width - size :])


@dataclass
class Runs:
    """Runs of passages, one starting at each byte of a run, that have the same anchor."""

    row: np.ndarray  # number of the document in its group
    begin: np.ndarray  # first byte of the first passage
    count: np.ndarray  # passages
    key: np.ndarray  # hash of the anchor


def anchored_runs(texts: list[bytes], min_bytes: int, bits: int) -> Runs:
    """All passages of all texts, as runs with one anchor: the least hash of the grams inside a passage.

    Equal passages have equal anchors wherever they stand, so only runs with the same key can share any.
    """
    gram = min(GRAM, min_bytes)
    width = min_bytes - gram + 1
    parts: list[tuple[np.ndarray, ...]] = []
    first = 0
    up, down = _powers(0)
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (size == 0 or size + len(texts[last]) <= _PIECE):
            size += len(texts[last])
            last += 1
        sizes = np.fromiter(map(len, texts[first:last]), np.int64, last - first)
        if size >= min_bytes:
            if len(up) < size + 1:
                up, down = _powers(size)
            data = np.frombuffer(b"".join(texts[first:last]), np.uint8).astype(np.uint64) + np.uint64(1)
            with np.errstate(over="ignore"):
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * up[:size], dtype=np.uint64)])
                grams = _mix((sums[gram:] - sums[:-gram]) * down[: size - gram + 1])
            least = _sliding_min(grams, width)
            ends = np.cumsum(sizes)
            owner = np.repeat(np.arange(last - first), sizes)[: len(least)]
            inside = np.arange(len(least)) + min_bytes <= ends[owner]
            at = np.flatnonzero(inside)
            if len(at):
                own, key = owner[at], least[at]
                new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])]))
                count = np.diff(np.concatenate([new, [len(at)]]))
                parts.append((own[new] + first, at[new] - (ends - sizes)[own[new]], count, _mix(key[new]) >> np.uint64(64 - bits)))
        first = last
    if not parts:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none.astype(np.uint64))
    return Runs(*(np.concatenate([p[k] for p in parts]) for k in range(4)))


def _pack(values: np.ndarray) -> bytes:
    """Ascending numbers as differences, in as few bytes each as the largest needs."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([width]) + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    width = data[0]
    wide = np.zeros(((len(data) - 1) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(wide.reshape(-1).view("<u8"), dtype=np.uint64)


@dataclass(frozen=True)
class Plan:
    """What follows from the size of the table: groups of documents, bits of a key, and of its bucket."""

    groups: int
    bits: int
    bucket_bits: int
    min_bytes: int

    def buckets(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(self.bits - self.bucket_bits)).astype(np.int64)


def plan_for(n_bytes: int, min_bytes: int = MIN_BYTES) -> Plan:
    anchors = n_bytes * 2 / max(2, min_bytes - GRAM + 2)
    bucket_bits = max(0, int(anchors // BUCKET_ANCHORS).bit_length())
    return Plan(int(n_bytes // GROUP_BYTES) + 1, min(63, max(n_bytes, 1).bit_length() + 14), bucket_bits, min_bytes)


@dataclass
class _Group:
    ids: np.ndarray
    null: np.ndarray
    texts: list[bytes]
    runs: Runs | None


def _group(table: pa.Table, plan: Plan | None) -> _Group:
    """The documents of a group in a fixed order, with their runs if a plan is given."""
    ids = table.column("doc_id").to_pylist()
    texts = table.column("data").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
    null = np.array([ids[i] is None for i in order], bool)
    keys = np.array([_LAST if ids[i] is None else ids[i] for i in order], np.int64)
    texts = [texts[i] for i in order]
    return _Group(keys, null, texts, anchored_runs(texts, plan.min_bytes, plan.bits) if plan else None)


def _cuts(buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of an ascending array."""
    if len(buckets):
        at = np.concatenate([[0], np.flatnonzero(np.diff(buckets)) + 1, [len(buckets)]])
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield int(buckets[a]), a, b


def _distinct(group: _Group) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a group, ascending, and whether several documents of the group have them."""
    keys, back = np.unique(group.runs.key, return_inverse=True)
    ids = group.ids[group.runs.row]
    low, high = np.full(len(keys), _LAST), np.full(len(keys), np.iinfo(np.int64).min)
    np.minimum.at(low, back, ids)
    np.maximum.at(high, back, ids)
    return keys, low < high


def _announce(table: pa.Table, plan: Plan) -> pa.Table:
    """Tell each bucket the keys of a group, and of how many runs (the next power of two) each is the anchor."""
    group = _group(table, plan)
    keys, several = _distinct(group)
    counts = np.unique(group.runs.key, return_counts=True)[1]
    powers = np.ceil(np.log2(np.maximum(counts, 1))).astype(np.uint8)
    rows = [
        (b, _pack(keys[i:j]), np.packbits(several[i:j]).tobytes(), powers[i:j].tobytes())
        for b, i, j in _cuts(plan.buckets(keys))
    ]
    g = table.column("g")[0].as_py()
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
    return pa.table([columns[0], pa.array([g] * len(rows), pa.int64()), *columns[1:]], ["bucket", "g", "keys", "several", "powers"])


def _answer(table: pa.Table, hot_runs: int) -> pa.Table:
    """Tell each group which of its keys other documents have too, and which are hot."""
    parts = [_unpack(k) for k in table.column("keys").to_pylist()]
    several = [np.unpackbits(np.frombuffer(s, np.uint8), count=len(p)).astype(bool) for s, p in zip(table.column("several").to_pylist(), parts, strict=True)]
    flat = np.concatenate(parts)
    powers = np.concatenate([np.frombuffer(p, np.uint8) for p in table.column("powers").to_pylist()])
    order = np.argsort(flat, kind="stable")
    ranked = flat[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    shared, hot = np.empty(len(flat), bool), np.empty(len(flat), bool)
    shared[order] = twice
    shared |= np.concatenate(several)
    stretch = np.cumsum(np.concatenate([[0], ~same]))
    hot[order] = np.bincount(stretch, 2.0 ** powers[order])[stretch] > hot_runs
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    masks, hots = ([np.packbits(m).tobytes() for m in np.split(x, cuts)] for x in (shared, hot & shared))
    return pa.table([table.column("g"), table.column("bucket"), pa.array(masks, pa.binary()), pa.array(hots, pa.binary())], ["g", "bucket", "mask", "hot"])


_RUN = np.dtype([("key", "<u8"), ("id", "<i8"), ("row", "<i4"), ("begin", "<i4"), ("size", "<i4")])
_SPAN = np.dtype([("row", "<i4"), ("begin", "<i4"), ("end", "<i4")])


def _send(texts: pa.Table, masks: pa.Table, plan: Plan) -> pa.Table:
    """Send the runs with shared anchors to their buckets, with their bytes.

    A run around a hot anchor is sent as its single passages, keyed by a hash of their bytes instead of the anchor: equal
    passages still meet, but the anchor's runs are spread over all buckets. Of runs with the same bytes in a group only
    that of the smallest id is sent. The others, if their id is larger, are repeats already; so a passage that fills
    a third of the table reaches its bucket once a group.
    """
    empty = pa.schema([("bucket", pa.int64()), ("g", pa.int64()), ("runs", pa.binary()), ("data", pa.binary()), ("done", pa.binary())]).empty_table()
    if not texts.num_rows or not masks.num_rows:
        return empty
    group = _group(texts, plan)
    runs = group.runs
    keys, back = np.unique(runs.key, return_inverse=True)
    sizes = {b: j - i for b, i, j in _cuts(plan.buckets(keys))}
    answers = sorted(zip(*(masks.column(c).to_pylist() for c in ("bucket", "mask", "hot")), strict=True))
    shared, hot = (
        np.concatenate([np.unpackbits(np.frombuffer(a[k], np.uint8), count=sizes[a[0]]) for a in answers]).astype(bool)[back]
        for k in (1, 2)
    )
    plain, spread = np.flatnonzero(shared & ~hot), np.flatnonzero(hot)
    n = runs.count[spread]
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    row = np.concatenate([runs.row[plain], np.repeat(runs.row[spread], n)])
    begin = np.concatenate([runs.begin[plain], np.repeat(runs.begin[spread], n) + inner])
    size = np.concatenate([runs.count[plain] + plan.min_bytes - 1, np.full(len(inner), plan.min_bytes)])
    key = np.concatenate([runs.key[plain], np.zeros(len(inner), np.uint64)])
    for i in range(len(plain), len(key)):
        passage = group.texts[row[i]][begin[i] : begin[i] + plan.min_bytes]
        key[i] = xxhash.xxh3_64_intdigest(passage) >> (64 - plan.bits)
    # In the order of ids, so that the first run with some bytes has the smallest one.
    order = np.lexsort((begin, row))
    key, row, begin, size = key[order], row[order], begin[order], size[order]
    first: dict[tuple[int, bytes], int] = {}
    texts_of = group.texts
    owner = np.fromiter(
        (
            first.setdefault((k, texts_of[r][a : a + z]), i)
            for i, (k, r, a, z) in enumerate(zip(key.tolist(), row.tolist(), begin.tolist(), size.tolist(), strict=True))
        ),
        np.int64,
        len(key),
    )
    first.clear()
    repeat = group.ids[row[owner]] < group.ids[row]
    spans = np.zeros(int(repeat.sum()), _SPAN)
    spans["row"], spans["begin"], spans["end"] = row[repeat], begin[repeat], begin[repeat] + size[repeat]
    sent = np.flatnonzero(~repeat)
    sent = sent[np.argsort(key[sent], kind="stable")]
    packed = np.zeros(len(sent), _RUN)
    packed["key"], packed["id"], packed["row"] = key[sent], group.ids[row[sent]], row[sent]
    packed["begin"], packed["size"] = begin[sent], size[sent]
    out = []
    for bucket, i, j in _cuts(plan.buckets(packed["key"])):
        part = packed[i:j]
        data = b"".join([texts_of[r][a : a + z] for r, a, z in zip(part["row"].tolist(), part["begin"].tolist(), part["size"].tolist(), strict=True)])
        out.append((bucket, part.tobytes(), data, b"" if out else spans.tobytes()))
    if not out:
        return empty
    g = texts.column("g")[0].as_py()
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    columns = [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)]
    return pa.table([columns[0], pa.array([g] * len(out), pa.int64()), *columns[1:]], ["bucket", "g", "runs", "data", "done"])


def suffix_order(data: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``starts`` in the order of their first ``size`` bytes (8 or more), and the length of the
    common prefix of each with the one before (0 for the first), at most ``size``."""
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    offsets = sorted({*range(0, size - 7, 8), size - 8})
    columns = [np.ascontiguousarray(words[starts + o]).view(">u8").reshape(-1).astype(np.uint64) for o in offsets]
    order = np.lexsort(columns[::-1])
    common = np.full(len(starts), size, np.int16)
    common[:1] = 0
    open_ = np.arange(1, len(starts))
    for o, c in zip(offsets, columns, strict=True):
        differ = c[order[open_]] ^ c[order[open_ - 1]]
        ends = differ > 0
        # The leading bytes that agree.
        agree = sum((differ[ends] < np.uint64(1 << 8 * k)).astype(np.int16) for k in range(1, 8))
        common[open_[ends]] = o + agree
        open_ = open_[~ends]
    return order, common


def _before(ids: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For suffixes in suffix order: the common prefix with the previous one of a smaller id; 0 without one.

    All suffixes follow their pointers at once; what lies between a suffix and the one its pointer names has no
    smaller id, so pointers of pointers may be taken. All steps together are at most one for each suffix.
    """
    at = np.arange(-1, len(ids) - 1)
    least = common.copy()
    walking = np.flatnonzero((least > 0) & (at >= 0))
    walking = walking[ids[at[walking]] >= ids[walking]]
    while len(walking):
        over = at[walking]
        shorter, further = np.minimum(least[walking], least[over]), at[over]
        least[walking], at[walking] = shorter, further
        walking = walking[(further >= 0) & (shorter > 0)]
        walking = walking[ids[at[walking]] >= ids[walking]]
    least[at < 0] = 0
    return least


def previous_factors(ids: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The array of longest previous factors: for suffixes in suffix order, with their common prefixes with the one
    before, the longest prefix that also starts at a suffix of a smaller id.

    It is the larger of the common prefixes with the previous and with the next smaller id in suffix order.
    """
    following = np.concatenate([[0], common[:0:-1]]).astype(common.dtype)[: len(ids)]
    return np.maximum(_before(ids, common), _before(ids[::-1], following)[::-1])


def _judge(runs: np.ndarray, begin: np.ndarray, data: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The repeated stretches of runs whose bytes start at ``begin`` of ``data``: number of the run, from, to."""
    count = runs["size"].astype(np.int64) - min_bytes + 1
    owner = np.repeat(np.arange(len(runs)), count)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    order, common = suffix_order(data, begin[owner] + inner, min_bytes)
    repeated = np.zeros(len(owner), bool)
    repeated[order] = previous_factors(runs["id"][owner[order]], common) >= min_bytes
    edge = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
    before = np.concatenate([[False], repeated[:-1]]) & ~edge
    after = np.concatenate([repeated[1:], [False]]) & ~np.concatenate([edge[1:], [True]])
    heads, tails = np.flatnonzero(repeated & ~before), np.flatnonzero(repeated & ~after)
    return owner[heads], inner[heads], inner[tails] + min_bytes


def _factors(table: pa.Table, plan: Plan) -> pa.Table:
    """The repeated spans among the runs of a bucket, for the groups they came from.

    Of runs with the same bytes those with larger ids are repeated whole. The others are judged by longest previous
    factors, a number of keys at a time, unless their key has no other bytes.
    """
    groups = table.column("g").to_pylist()
    parts = [np.frombuffer(r, _RUN) for r in table.column("runs").to_pylist()]
    runs = np.concatenate(parts)
    source = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    joined = b"".join(table.column("data").to_pylist())
    data = np.frombuffer(joined, np.uint8)
    sizes = runs["size"].astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    order = np.lexsort((runs["id"], runs["key"]))
    runs, source, begin, sizes = runs[order], source[order], begin[order], sizes[order]
    first: dict[tuple[int, bytes], int] = {}
    owner = np.fromiter(
        (
            first.setdefault((k, joined[a : a + z]), i)
            for i, (k, a, z) in enumerate(zip(runs["key"].tolist(), begin.tolist(), sizes.tolist(), strict=True))
        ),
        np.int64,
        len(runs),
    )
    first.clear()
    whole = runs["id"][owner] < runs["id"]
    number = np.cumsum(np.concatenate([[0], runs["key"][1:] != runs["key"][:-1]])) if len(runs) else owner
    texts_of_key = np.bincount(number[owner == np.arange(len(runs))], minlength=1)
    judged = np.flatnonzero(~whole & (texts_of_key[number] > 1))
    at, low, high = [np.flatnonzero(whole)], [np.zeros(int(whole.sum()), np.int64)], [sizes[whole]]
    passages = np.cumsum(sizes[judged] - plan.min_bytes + 1)
    start = 0
    while start < len(judged):
        done = passages[start - 1] if start else 0
        stop = max(int(np.searchsorted(passages, done + PASSAGES)), start + 1)
        # Up to the end of the last key.
        stop = int(np.searchsorted(number[judged], number[judged[stop - 1]], "right"))
        own = judged[start:stop]
        k, a, b = _judge(runs[own], begin[own], data, plan.min_bytes)
        at.append(own[k])
        low.append(a)
        high.append(b)
        start = stop
    at, low, high = (np.concatenate(x) for x in (at, low, high))
    order = np.argsort(source[at], kind="stable")
    at, low, high = at[order], low[order], high[order]
    spans = np.zeros(len(at), _SPAN)
    spans["row"], spans["begin"], spans["end"] = runs["row"][at], runs["begin"][at] + low, runs["begin"][at] + high
    cuts = np.searchsorted(source[at], np.arange(len(parts) + 1))
    done = table.column("done").to_pylist()
    found = [spans[a:b].tobytes() + d for a, b, d in zip(cuts[:-1], cuts[1:], done, strict=True)]
    kept = [k for k, f in enumerate(found) if f]
    return pa.table([pa.array([groups[k] for k in kept], pa.int64()), pa.array([found[k] for k in kept], pa.binary())], ["g", "spans"])


def _cut(texts: pa.Table, spans: pa.Table, keep_text: bool) -> pa.Table:
    """Cut the repeated spans out of a group's documents."""
    # The same order of documents as before; anchors are no longer needed.
    group = _group(texts, None)
    cut = np.frombuffer(b"".join(spans.column("spans").to_pylist()), _SPAN)
    cut = cut[np.argsort(cut["row"], kind="stable")]
    at = np.searchsorted(cut["row"], np.arange(len(group.texts) + 1))
    rows = []
    for k, data in enumerate(group.texts):
        own, gone, n_spans = cut[at[k] : at[k + 1]], 0, 0
        if len(own):
            edges = np.zeros(len(data) + 1, np.int32)
            np.add.at(edges, own["begin"], 1)
            np.add.at(edges, own["end"], -1)
            out = np.cumsum(edges[:-1]) > 0
            gone, n_spans = int(out.sum()), int(out[0]) + int((out[1:] & ~out[:-1]).sum())
            data = np.frombuffer(data, np.uint8)[~out].tobytes()
        row = [None if group.null[k] else int(group.ids[k]), len(data) + gone, gone, n_spans, hashlib.sha256(data).hexdigest()]
        rows.append((*row, data) if keep_text else tuple(row))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    kinds = [*[pa.int64()] * 4, pa.string(), pa.binary()]
    n = 6 if keep_text else 5
    return pa.table([pa.array([r[i] for r in rows], kinds[i]) for i in range(n)], names[:n])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_bytes: int = MIN_BYTES, keep_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with ``keep_text`` kept (binary).

    Removed is each byte covered by ``min_bytes`` bytes (8 or more) that also start in a document with a smaller
    doc_id, judged on the input. Matches stay inside documents; null texts are empty; a null id comes after all
    others; documents with the same id don't cut each other. An empty table gives no rows.

    All passages of all documents take part, but only those come together that can be equal. A passage has an
    anchor, the gram of least hash inside it. The documents, dealt into groups by a hash, tell buckets of keys
    their anchors; the buckets answer which are shared; the runs of passages around shared anchors go to the
    buckets with their bytes. There they are brought into suffix order; from the common prefixes of neighbours and the
    previous and next smaller ids follow the longest previous factors, cut at ``min_bytes``, and those of
    that length are repeats. The spans found go back to the groups. The passages of an anchor with more than
    about ``HOT_RUNS`` runs go to buckets by their own bytes. The text itself is shuffled once, and that exchange is read three times.
    """
    if min_bytes < 8:
        raise ValueError("min_bytes must be 8 or more")
    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("data"))
    plan = plan_for(rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0, min_bytes)
    rows = rows.withColumn("g", F.pmod(F.xxhash64("doc_id", "data"), F.lit(plan.groups)))
    groups = rows.groupBy("g")
    told = groups.applyInArrow(lambda t: _announce(t, plan), "bucket long, g long, keys binary, several binary, powers binary")
    hot_runs = HOT_RUNS
    masks = told.groupBy("bucket").applyInArrow(lambda t: _answer(t, hot_runs), "g long, bucket long, mask binary, hot binary")
    sent = groups.cogroup(masks.groupBy("g")).applyInArrow(
        lambda a, b: _send(a, b, plan), "bucket long, g long, runs binary, data binary, done binary"
    )
    spans = sent.groupBy("bucket").applyInArrow(lambda t: _factors(t, plan), "g long, spans binary")
    kinds = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_text else "")
    return groups.cogroup(spans.groupBy("g")).applyInArrow(lambda a, b: _cut(a, b, keep_text), kinds)
