"""Quality of documents by a factorisation machine over words, structure and metadata."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import map_batches

#: Labelled rows a model is fitted on, at most.
SAMPLE_ROWS = 4_000
#: Word buckets, factors per feature, passes over the sample.
BUCKETS, FACTORS, EPOCHS = 1 << 14, 8, 6
LEARNING_RATE, L2 = 0.05, 1e-5
THRESHOLD = 0.3
#: Equal steps in which a statistic between 0 and 1 is counted.
STEPS = 12
_RUNS = re.compile(r"[^\w\s]{2,}")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[^\w\s]")


def _share(n: float, of: float) -> float:
    return n / of if of else 0.0


def structure(text: str, counts: Counter, n_chars: int | None) -> list[float]:
    """Statistics of a text, each from 0 to 1. ``n_chars`` is the table's own length, if it has one."""
    n, n_words, lines = len(text), counts.total(), text.split("\n")
    short = sum(k * c for k, c in ((len(w), c) for w, c in counts.items()))
    longest = counts.most_common(1)[0][1] if counts else 0
    filled = [x for x in lines if x]
    return [
        min(1.0, np.log1p(n) / 14),
        min(1.0, _share(short, n_words) / 20),
        _share(len(counts), n_words),
        _share(longest, n_words),
        _share(len(_UPPER.findall(text)), n),
        _share(len(_DIGIT.findall(text)), n),
        min(1.0, 2 * _share(len(_MARK.findall(text)), n)),
        min(1.0, _share(len(_RUNS.findall(text)), n_words)),
        1 - _share(len(set(filled)), len(filled)) if filled else 0.0,
        min(1.0, _share(len(lines), n_words)),
        min(1.0, np.log1p(max(n_chars or 0, 0)) / 14),
        1.0 if n_chars is not None and n_chars != n else 0.0,
    ]


N_STATS = 12
N_FEATURES = BUCKETS + N_STATS * (STEPS + 1)


def features(text: str, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values: hashed words of norm 1, and each statistic as steps of a scale.

    A statistic lights the two marks of its scale that it lies between, in proportion, so that the machine can
    bend its answer along it and combine ranges of two statistics.
    """
    counts = Counter(text.split())
    words: Counter = Counter()
    for word, n in counts.items():
        words[zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % BUCKETS] += n
    index = np.fromiter(words.keys(), np.int32, len(words))
    value = np.log1p(np.fromiter(words.values(), np.float64, len(words)))
    value /= np.sqrt((value * value).sum()) or 1.0
    scale = np.clip(np.array(structure(text, counts, n_chars)), 0, 1) * STEPS
    low = np.minimum(scale.astype(np.int32), STEPS - 1)
    base = BUCKETS + np.arange(N_STATS) * (STEPS + 1) + low
    marks = np.concatenate([base, base + 1]).astype(np.int32)
    return np.concatenate([index, marks]), np.concatenate([value, 1 - (scale - low), scale - low]).astype(np.float32)


@dataclass(frozen=True)
class FactorisationMachine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, index: np.ndarray, value: np.ndarray) -> float:
        """bias + sum w x + the sum of all pairs <v_i, v_j> x_i x_j, as half of (sum v x)^2 - sum (v x)^2."""
        vx = self.factors[index] * value[:, None]
        total = vx.sum(axis=0)
        return float(self.bias + self.weights[index] @ value + 0.5 * ((total * total).sum() - (vx * vx).sum()))

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(index, value), -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], epochs: int = EPOCHS) -> FactorisationMachine:
    """Logistic loss, AdaGrad, one row at a time in a fixed order of rows; both classes weigh the same in all."""
    rng = np.random.default_rng(7)
    w, v, bias = np.zeros(N_FEATURES), rng.normal(0, 0.05, (N_FEATURES, FACTORS)), 0.0
    gw, gv, gb = np.full(N_FEATURES, 1e-3), np.full((N_FEATURES, FACTORS), 1e-3), 1e-3
    n_one = sum(labels)
    weight = {1: len(labels) / (2 * n_one) if n_one else 0, 0: len(labels) / (2 * (len(labels) - n_one)) if n_one < len(labels) else 0}
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            (i, x), y = rows[k], labels[k]
            vi = v[i]
            vx = vi * x[:, None]
            total = vx.sum(axis=0)
            raw = bias + w[i] @ x + 0.5 * ((total * total).sum() - (vx * vx).sum())
            g = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y) * weight[y]
            dw = g * x + L2 * w[i]
            dv = g * x[:, None] * (total - vx) + L2 * vi
            gw[i] += dw * dw
            gv[i] += dv * dv
            gb += g * g
            w[i] -= LEARNING_RATE * dw / np.sqrt(gw[i])
            v[i] = vi - LEARNING_RATE * dv / np.sqrt(gv[i])
            bias -= LEARNING_RATE * g / np.sqrt(gb)
    return FactorisationMachine(bias, w, v)


def _inputs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and the table's n_chars, null where it has no such column."""
    known = next((c for c in docs.columns if c == "n_chars" and dict(docs.dtypes)[c] in ("bigint", "int")), None)
    n_chars = F.col(known).cast("long") if known else F.lit(None).cast("long")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), n_chars.alias("n_chars")
    )


def held_out(doc_id: str, parts: int, part: int):
    """Whether the crc32 of the id as text leaves ``part`` when divided by ``parts``; null ids are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> FactorisationMachine:
    """Fit on at most ``sample_rows`` labelled rows that aren't held out, chosen by a hash of the id.

    Of a repeated id one row is taken, by a hash of its text. The driver sees the features of the sample only,
    which the two bounds limit: rows, and buckets per row.
    Without labels of both kinds every weight stays near zero and scores stay near one half.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & ~held_out("doc_id", 5, 0))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
        .collect()
    )
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast({r["doc_id"]: r["label"] for r in chosen})

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "n_chars"))
        for doc_id, text, n_chars in zip(*columns, strict=True):
            if doc_id in known.value:
                index, value = features(text, n_chars)
                out.append((doc_id, index.tobytes(), value.tobytes()))
        kinds = (pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["doc_id", "i", "x"])

    ids = spark.createDataFrame([(r["doc_id"],) for r in chosen], "doc_id long")
    # The ids are bounded by sample_rows.
    texts = _inputs(docs, id_col, text_col).join(F.broadcast(ids), "doc_id", "left_semi")
    one = F.max(F.struct(F.crc32(F.col("text").cast("binary")).alias("crc"), "text", "n_chars")).alias("one")
    texts = texts.groupBy("doc_id").agg(one).select("doc_id", "one.text", "one.n_chars")
    got = map_batches(texts.select("doc_id", "text", "n_chars"), step, "doc_id long, i binary, x binary").collect()
    got = sorted(got, key=lambda r: r["doc_id"])
    rows = [(np.frombuffer(r["i"], np.int32), np.frombuffer(r["x"], np.float32)) for r in got]
    return fit(rows, [known.value[r["doc_id"]] for r in got])


def score(docs: DataFrame, model: FactorisationMachine, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Null and empty texts are scored by their statistics.

    Every row is scored by itself, so repeated rows get the same score and other columns make no difference.
    An empty table gives no rows; rows without an id count as held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = shared.value
        texts = zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist(), strict=True)
        scores = [machine.score(*features(text, n_chars)) for text, n_chars in texts]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = map_batches(_inputs(docs, id_col, text_col), step, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def good_rows(docs: DataFrame, model: FactorisationMachine, text_col: str = "text", *, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``; each is judged where it lies.

    The score is that of :func:`score`; nothing is shuffled, and rows need no key.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    counted = dict(docs.dtypes).get("n_chars") in ("bigint", "int")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = shared.value
        sizes = batch.column("n_chars").to_pylist() if counted else [None] * batch.num_rows
        texts = zip(batch.column(text_col).to_pylist(), sizes, strict=True)
        good = [machine.score(*features("" if text is None else str(text), n)) >= threshold for text, n in texts]
        return batch.filter(pa.array(good, pa.bool_()))

    return map_batches(docs, step, docs.schema)
