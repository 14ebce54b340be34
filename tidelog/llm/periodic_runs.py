"""Stretches of words that repeat with a period, found through string synchronising sets."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidelog.llm.common import id_and_text, map_batches

#: A run holds its period at least four times; the scales below rely on that. It has so many words at least.
POWER, MIN_WORDS = 4, 6
#: Periods that are looked for directly, by comparing words so far apart.
DIRECT = (1, 2, 3)
#: Texts of so many bytes (or one longer text) are worked on at once.
CHUNK_BYTES = 4_000_000

Runs = np.ndarray  # rows of start, end, period
_NEVER = np.uint64(2**64 - 1)


def window_names(first: np.ndarray, limit: int | None = None) -> list[np.ndarray]:
    """For each level l, names of the 2**l words from every position on: equal names, equal words.

    ``first`` names single words so that no two documents share a name. A window that does not occur twice has no
    name (-1); neither has one across documents, nor any longer window around it. So ordinary texts are through
    after a few levels, and the levels end where no window occurs twice (or at ``limit``).
    """
    n, levels = len(first), []
    at, key = np.arange(n), first
    while len(at) and len(levels) != limit:
        _, back, counts = np.unique(key, return_inverse=True, return_counts=True)
        twice = counts[back] > 1
        name = np.full(n, -1, np.int64)
        name[at[twice]] = back[twice]
        levels.append(name)
        half = 1 << len(levels) - 1
        at = at[twice]
        at = at[at + half < n]
        at = at[name[at + half] >= 0]
        key = name[at] * (n + 1) + name[at + half]
    return levels


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


def direct_runs(first: np.ndarray) -> Runs:
    """Runs of the periods in DIRECT, also those under MIN_WORDS words."""
    found = []
    for q in DIRECT:
        starts, ends = _stretches(first[:-q] == first[q:])
        fits = ends - starts >= (POWER - 1) * q
        starts, ends = starts[fits], ends[fits] + q
        if q > 1:
            # A smaller period would divide this one, and the divisors of 2 and 3 are 1 alone.
            single = np.logical_and.reduce([first[starts] == first[starts + k] for k in range(1, q)])
            starts, ends = starts[~single], ends[~single]
        found.append(np.column_stack((starts, ends, np.full(len(starts), q))))
    return np.concatenate(found)


def synchronising_set(names: np.ndarray, scale: int, regions: Runs) -> np.ndarray:
    """Positions selected by what the next ``2 * scale`` words are, and by nothing else.

    Every window of ``scale`` words has a hash as its key. A position is selected if the least key of the windows
    that start within ``scale`` words is that of the first or the last of them. Windows inside a highly periodic
    region (a run of period ``scale / 4`` at most) have no key, so nothing is selected where all is periodic; the
    same holds for windows that occur once, which no equal context can contain. Elsewhere any ``scale`` positions
    in a row hold a selected one.
    """
    n = len(names)
    edges = np.zeros(n + 1, np.int64)
    wide = regions[(regions[:, 2] * POWER <= scale) & (regions[:, 1] - regions[:, 0] >= scale)]
    np.add.at(edges, wide[:, 0], 1)
    np.add.at(edges, wide[:, 1] - scale + 1, -1)
    keyed = (names >= 0) & (np.cumsum(edges[:n]) == 0)
    key = np.full(n + scale + 1, _NEVER)
    # A bijective mixing of the names, so that different windows never have equal keys.
    mixed = (names[keyed].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    key[:n][keyed] = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    least, width = key, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-1], least[1:])[:n]
    return np.flatnonzero((least != _NEVER) & ((least == key[:n]) | (least == key[scale : n + scale])))


def _extended(levels: list[np.ndarray], at: np.ndarray, period: np.ndarray) -> Runs:
    """The longest stretches around ``at`` whose words are equal to those ``period`` later, by binary steps."""
    n = len(levels[0])
    end, start = at.copy(), at.copy()
    for level in reversed(range(len(levels))):
        name, step = levels[level], 1 << level
        far = end + period
        there = name[np.minimum(far, n - 1)]
        end += step * ((far < n) & (there >= 0) & (name[np.minimum(end, n - 1)] == there))
        near = start - step
        there = name[np.maximum(near, 0)]
        start -= step * ((near >= 0) & (there >= 0) & (name[np.maximum(near, 0) + period] == there))
    return np.column_stack((start, end + period, period))


def synchronised_runs(first: np.ndarray, regions: Runs) -> Runs:
    """``regions`` and all runs of longer periods.

    At scale t (a power of two) the periods from t to 2t - 1 are proposed: neighbouring selected positions with
    equal next 2t words, so far apart. A run of such a period holds a selected position among its first t, since
    no window of 3t - 1 words in it has a period of t / 4 or less as well, and again one period later with the
    same context, since it holds the period four times; nothing of that context lies between.
    """
    levels = window_names(first)
    for level in range(2, len(levels) - 1):
        scale = 1 << level
        at = synchronising_set(levels[level], scale, regions)
        context = levels[level + 1][at]
        at, context = at[context >= 0], context[context >= 0]
        order = np.argsort(context, kind="stable")
        at, context = at[order], context[order]
        gap = at[1:] - at[:-1]
        proposed = (context[1:] == context[:-1]) & (gap >= scale) & (gap < 2 * scale)
        found = _extended(levels, at[:-1][proposed], gap[proposed])
        found = found[found[:, 1] - found[:, 0] >= POWER * found[:, 2]]
        regions = np.concatenate((regions, np.unique(found, axis=0)))
    return regions


def runs_of(texts: list[list[bytes]], min_words: int = MIN_WORDS) -> list[list[tuple[int, int, int]]]:
    """For each text, given as its words, its runs (start, length, period), by start and period.

    A run is a stretch of words whose smallest period fits in four times at least, which has ``min_words`` words
    at least, and which no neighbouring word extends.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    named: list[int] = []
    for words in texts:
        own = {w: k for k, w in enumerate(dict.fromkeys(words), len(named))}
        named += map(own.__getitem__, words)
    first = np.array(named, np.int64)
    found = direct_runs(first) if len(first) > max(DIRECT) else np.empty((0, 3), np.int64)
    # Longer periods need eight words that occur twice; few texts have them.
    levels = window_names(first, 4)
    if len(levels) == 4 and (levels[3] >= 0).any():
        deep = np.isin(np.arange(len(texts)), np.searchsorted(ends, np.flatnonzero(levels[3] >= 0), "right"))
        inside = np.flatnonzero(np.repeat(deep, sizes))
        place = np.full(len(first) + 1, -1)
        place[inside] = np.arange(len(inside))
        own = place[found[:, 0]] >= 0
        regions = found[own].copy()
        regions[:, 1] += place[regions[:, 0]] - regions[:, 0]
        regions[:, 0] = place[regions[:, 0]]
        longer = synchronised_runs(first[inside], regions)[len(regions) :]
        longer[:, 1] += inside[longer[:, 0]] - longer[:, 0]
        longer[:, 0] = inside[longer[:, 0]]
        found = np.concatenate((found, longer))
    found = found[found[:, 1] - found[:, 0] >= min_words]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    owner = np.searchsorted(ends, found[:, 0], "right")
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (start, end, period) in zip(owner.tolist(), found.tolist(), strict=True):
        out[k].append((start - int(ends[k] - sizes[k]), end - start, period))
    return out


def planted_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document with a periodic tail planted by its id, as the contract of op11 states.

    One document in ten, by the crc32 of its decimal id, repeats a stretch from some word on. A null id has no
    crc32: its words stay.
    """
    n = len(words)
    if doc_id is None or n == 0 or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def find(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    min_words: int = MIN_WORDS,
    prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
    keep_text: bool = True,
) -> DataFrame:
    """One row per document: its runs, the greatest of them, and its words without what runs repeat.

    Columns doc_id, n_runs; start, length, period, exponent_milli of the longest run (ties: smallest start, then
    period), null without runs; runs_sha256 (every run's ``start,length,period`` and a line feed, by start, then
    period), collapsed_sha256 (the words that are in no run after that run's first period, joined by one space).
    With ``keep_text`` also runs and collapsed themselves. ``prepare`` may change the words of a document first.

    Null, empty and blank texts have no words and no runs. Each document stands alone, so repeated rows, ties and
    extra columns make no difference, and texts of any length are taken whole, in time n log n squared. An empty
    table gives no rows.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        rows: list[tuple] = []
        chunk: list[list[bytes]] = []
        room = CHUNK_BYTES
        for i, text in zip(ids, texts, strict=True):
            data = text.as_py().encode("utf-8", "surrogatepass")
            words = data.split()
            chunk.append(prepare(i, words) if prepare else words)
            room -= len(data)
            if room <= 0:
                rows += map(answer, chunk, runs_of(chunk, min_words))
                chunk, room = [], CHUNK_BYTES
        rows += map(answer, chunk, runs_of(chunk, min_words))
        made = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names)

    def answer(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        listed = "".join([f"{s},{n},{q}\n" for s, n, q in runs])
        kept, at = words, 0
        if runs:
            kept = []
            for a, b in sorted((s + q, s + n) for s, n, q in runs):
                kept += words[at:a]
                at = max(at, b)
            kept += words[at:]
        text = b" ".join(kept)
        largest = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        row = (len(runs), *largest, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest())
        if not keep_text:
            return row
        return (*row, [dict(zip(entry, r, strict=True)) for r in runs], text.decode("utf-8", "surrogatepass"))

    entry = ("start", "length", "period")
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    schema = ", ".join(f"{c} {'string' if c.endswith('256') else 'long'}" for c in names)
    if keep_text:
        listed_runs = pa.list_(pa.struct([(c, pa.int64()) for c in entry]))
        kinds, names = [*kinds, listed_runs, pa.string()], [*names, "runs", "collapsed"]
        schema += ", runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return map_batches(id_and_text(docs, id_col, text_col), step, schema)
