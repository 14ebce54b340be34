"""Toxicity by a weighted pattern grammar over clauses."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import id_and_text, map_batches
from tidelog.llm.quality import held_out
from tidelog.session import stored

#: Labelled rows the grammar's weights are learned from, and insulting stems it keeps, at most.
SAMPLE_ROWS, MAX_STEMS = 5_000, 5_000
THRESHOLD = 0.7
#: A stem is a whole word or a beginning of this many letters.
PREFIXES = (4, 5, 6)
#: An insulting stem follows at least so many different words in toxic texts, and is so much likelier there.
MIN_CONTEXTS, MIN_LIFT = 6, 40.0

#: A threat weighs this much before labels say otherwise, which counts like so many clauses seen.
THREAT_WEIGHT, THREAT_PRIOR = 1.0, 10

# Word lists of the grammar, in the table's languages. Addressees strengthen insults.
ADDRESSEES = "you your yours yourself u tu toi vous te ton ta tes votre vos du dich dir dein deine sie euch ihr tú usted ustedes ti vosotros"
NEGATIONS = "not no never nor without don doesn isn aren wasn n't ne pas jamais non sans nicht kein keine nie ohne nunca jamás ni sin"
REPORTS = "said says say told tells wrote writes claimed claims quoted quotes called calls dit disait écrit raconte sagte sagt schrieb schreibt behauptet dijo dice escribió cuenta"
#: Of each language: whom a threat is aimed at, those of them that are always objects, words that announce an act, acts
#: against somebody, acts with the announcement in their ending, and fates that need no object.
THREATS = {
    "en": {"target": "you u yourself", "object": "", "modal": "will shall ll going gonna must should", "harm": "kill hurt destroy burn hang shoot stab beat punch crush", "future": "", "fate": "die"},
    "fr": {"target": "tu te toi vous", "object": "te toi", "modal": "vais va allons vont veux", "harm": "tuer frapper détruire brûler", "future": "tuerai tuerons frapperai détruirai brûlerai", "fate": "mourir crever"},
    "de": {"target": "du dich dir sie euch ihr ihnen", "object": "dich dir euch", "modal": "werde werden wird wirst will muss", "harm": "töten schlagen zerstören verbrennen", "future": "", "fate": "sterben verrecken"},
    "es": {"target": "te ti tú usted ustedes", "object": "te ti", "modal": "voy va vamos van vas quiero", "harm": "matar matarte golpear destruir quemar", "future": "mataré golpearé destruiré quemaré", "fate": "morir"},
}
#: Words that begin a clause of their own.
BREAKS = frozenset("but mais aber sondern pero sino".split())


def _marks() -> dict[str, tuple[str, ...]]:
    """The marks of each word of the lists; a word may have several, of several languages."""
    lists = {"addressee": ADDRESSEES, "negation": NEGATIONS, "report": REPORTS}
    lists |= {f"{part}-{lang}": words for lang, parts in THREATS.items() for part, words in parts.items()}
    found: dict[str, list[str]] = {}
    for mark, words in lists.items():
        for word in words.split():
            found.setdefault(word, []).append(mark)
    return {word: tuple(sorted(marks)) for word, marks in found.items()}


MARKS = _marks()
#: Words without which there is no threat, of each language.
_ACTS = frozenset(w for w, marks in MARKS.items() if any(m.split("-")[0] in ("harm", "future", "fate") for m in marks))
_TARGETS = frozenset(w for w, marks in MARKS.items() if any(m.startswith("target-") for m in marks))

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;,:\n]")
_WORD = re.compile(r"[^\W\d_]+")
_ENDS, _PAUSES = frozenset(".!?;\n"), frozenset(",:")


class Weakener:
    """A transducer that weighs what follows its marks within ``scope`` words; ``lasting`` over the clause's end."""

    begin = 0

    def __init__(self, mark: str, scope: int, factor: float, lasting: bool = False):
        self.mark, self.scope, self.factor, self.lasting = mark, scope, factor, lasting

    def step(self, left: int, marks: tuple[str, ...]) -> tuple[int, float, int, int]:
        if self.mark in marks:
            return self.scope, 1.0, 0, 0
        return max(left - 1, 0), self.factor if left else 1.0, 0, 0


class Insult:
    """The transducer of insulting words: it finds one at each."""

    begin, lasting = 0, False

    def step(self, state: int, marks: tuple[str, ...]) -> tuple[int, float, int, int]:
        return state, 1.0, int("insult" in marks), 0


class Threat:
    """The transducer of a language's threats: an announced act with its object, or a fate with its subject.

    The object stands after the announcing word or behind the act, or is always one; its state counts the words for
    which a target, an object, an announcement and an act still stand open.
    """

    begin, lasting = (0, 0, 0, 0), False

    def __init__(self, lang: str):
        self.part = {f"{part}-{lang}": part for part in THREATS[lang]}

    def step(self, state: tuple[int, ...], marks: tuple[str, ...]) -> tuple[tuple[int, ...], float, int, int]:
        own = {self.part[m] for m in marks if m in self.part}
        target, object_, modal, act = state
        after, found = [max(n - 1, 0) for n in state], 0
        if "target" in own:
            after[0] = 6
            if act:
                found, after[3] = 1, 0
            if modal or "object" in own:
                after[1] = 6
        if "modal" in own:
            after[2] = 4
        if "future" in own or ("harm" in own and modal):
            if object_:
                found = 1
            else:
                after[3] = 3
        if "fate" in own and modal and target:
            found = 1
        return tuple(after), 1.0, 0, found


#: An addressee before an insult or threat strengthens it; negation and reported speech weaken what follows.
PARTS = (
    Insult(),
    *map(Threat, THREATS),
    Weakener("addressee", 6, 1.5),
    Weakener("negation", 3, 0.5),
    Weakener("report", 20, 0.6, lasting=True),
)
BEGIN = tuple(p.begin for p in PARTS)


@lru_cache(maxsize=100_000)
def step(state: tuple, marks: tuple[str, ...]) -> tuple[tuple, float, int, int]:
    """The parts composed into one machine, whose states are made as they are reached: the next state, the product of
    the factors, and the insults and threats found."""
    each = [p.step(s, marks) for p, s in zip(PARTS, state, strict=True)]
    factor = float(np.prod([e[1] for e in each]))
    return tuple(e[0] for e in each), factor, sum(e[2] for e in each), min(1, sum(e[3] for e in each))


def _paused(state: tuple) -> tuple:
    """The state with which the next clause of a sentence begins."""
    return tuple(s if p.lasting else p.begin for p, s in zip(PARTS, state, strict=True))


@dataclass(frozen=True)
class Toxicity:
    """``stems``: insulting words (ending in ``$``) and beginnings, with weights; ``threat``: the weight of a threat.
    The rest calibrates scores."""

    stems: dict[str, float]
    scale: tuple[float, float, float, float]
    threat: float = THREAT_WEIGHT

    def weight(self, word: str) -> float:
        find = self.stems.get
        return max(find(word + "$", 0.0), *(find(word[:n], 0.0) for n in PREFIXES))

    def _matches(self, text: str) -> list[tuple[int, int, float, int]]:
        found, state, total, threats, start = [], BEGIN, 0.0, 0, 0
        for m in _TOKEN.finditer(text.lower()):
            word = m[0]
            if word in _ENDS or word in _PAUSES or word in BREAKS:
                if total or threats:
                    found.append((start, m.start(), total, threats))
                total, threats, start = 0.0, 0, m.start() if word in BREAKS else m.end()
                state = BEGIN if word in _ENDS else _paused(state)
                continue
            weight, marks = self.weight(word), MARKS.get(word, ())
            if weight:
                marks += ("insult",)
            if marks or state != BEGIN:
                state, factor, insults, threat = step(state, marks)
                total += (insults * weight + threat * self.threat) * factor
                threats += threat
        if total or threats:
            found.append((start, len(text), total, threats))
        return found

    def clauses(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, score) of the clauses that the grammar matches."""
        return [c[:3] for c in self._matches(text) if c[2]]

    def has_threat(self, text: str) -> bool:
        words = set(_WORD.findall(text.lower()))
        return bool(words & _ACTS and words & _TARGETS) and any(c[3] for c in self._matches(text))

    def evidence(self, text: str) -> tuple[float, float]:
        """Sum and maximum of the clauses' scores. The grammar only runs over texts that have a word for it."""
        words = set(_WORD.findall(text.lower()))
        if not any(self.weight(w) for w in words) and not (words & _ACTS and words & _TARGETS):
            return 0.0, 0.0
        scores = [s for _, _, s in self.clauses(text)]
        return (float(np.log1p(sum(scores))), float(np.log1p(max(scores)))) if scores else (0.0, 0.0)

    def score(self, text: str) -> float:
        total, most = self.evidence(text)
        bias, some, a, b = self.scale
        return float(1 / (1 + np.exp(-np.clip(bias + (some if total else 0) + a * total + b * most, -30, 30))))


def _stem_contexts(sample: DataFrame) -> DataFrame:
    """(stem, toxic, clean): behind how many different words a stem stands in toxic and in clean texts.

    Counting neighbours instead of texts keeps copies of one text from looking like evidence.
    """

    def count(texts: list[str], toxic: list[int]) -> pa.RecordBatch:
        seen: dict[tuple[str, str], int] = {}
        for text, label in zip(texts, toxic, strict=True):
            last = ""
            for word in _WORD.findall(text.lower()):
                if len(word) <= 40:
                    for stem in (word + "$", *(word[:n] for n in PREFIXES if len(word) >= n)):
                        seen[stem, last] = seen.get((stem, last), 0) | (2 if label else 1)
                    last = word
        columns = [pa.array([k[i] for k in seen], pa.string()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(list(seen.values()), pa.int32())], ["stem", "before", "kinds"])

    def step(batch: pa.RecordBatch) -> pa.Table:
        texts, toxic = batch.column("text").to_pylist(), batch.column("label").to_pylist()
        # A few texts at a time bound the memory.
        return pa.Table.from_batches([count(texts[i : i + 200], toxic[i : i + 200]) for i in range(0, max(len(texts), 1), 200)])

    pairs = map_batches(sample.select("text", "label"), step, "stem string, before string, kinds int")
    pairs = pairs.groupBy("stem", "before").agg(F.bit_or("kinds").alias("kinds"))
    return pairs.groupBy("stem").agg(
        F.sum((F.col("kinds") >= 2).cast("long")).alias("toxic"), F.sum((F.col("kinds") % 2 == 1).cast("long")).alias("clean")
    )


def threat_weight(counts: dict[tuple[int, bool], int]) -> float:
    """The log ratio of threats in toxic and in clean texts, from counts by (label, has a threat).

    It is drawn towards ``THREAT_WEIGHT``, which decides alone where no text has a threat; never below zero.
    """
    toxic, clean = counts.get((1, True), 0), counts.get((0, True), 0)
    seen = toxic + clean
    if not seen:
        return THREAT_WEIGHT
    shares = [(n + 0.5) / (n + counts.get((label, False), 0) + 1) for label, n in ((1, toxic), (0, clean))]
    learned = float(np.log(shares[0] / shares[1]))
    return max(0.0, (seen * learned + THREAT_PRIOR * THREAT_WEIGHT) / (seen + THREAT_PRIOR))


def calibrate(evidence: Iterable[tuple[tuple[float, float], int]]) -> tuple[float, float, float, float]:
    """Logistic regression on (any match, sum, maximum) by Newton steps; its slopes are never negative."""
    counted = Counter(evidence)
    x = np.array([k[0] for k in counted], np.float64).reshape(-1, 2)
    x = np.column_stack([np.ones(len(x)), x[:, 0] > 0, x])
    y, n = np.array([k[1] for k in counted], np.float64), np.array(list(counted.values()), np.float64)
    w, free = np.array([-2.0, 1.0, 0.5, 0.5]), [0, 1, 2, 3]
    ridge = np.diag([1e-3, 1e-2, 1e-2, 1e-2])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + ridge @ w
        bend = (x.T * (n * p * (1 - p))) @ x + ridge
        w[free] -= np.clip(np.linalg.solve(bend[np.ix_(free, free)], slope[free]), -2, 2)
        if (low := min(free[1:], key=lambda k: w[k], default=0)) and w[low] < 0:
            free.remove(low)
            w[low] = 0.0
    return tuple(w.tolist())


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Toxicity:
    """Learn insulting stems, the weight of threats and the calibration from at most ``sample_rows`` labelled rows that aren't held out.

    Of a repeated id one row is taken, by a hash of its text. Without toxic rows there are no stems, and all
    scores are low.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & ~held_out("doc_id", 3, 1))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    # Bounded by sample_rows.
    labelled = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
    one = F.max(F.struct(F.crc32(F.col("text").cast("binary")).alias("crc"), "text", "label")).alias("one")
    sample = stored(labelled.groupBy("doc_id").agg(one).select("one.text", "one.label"), "toxic-sample")
    counted = stored(_stem_contexts(sample), "stems")
    sums = counted.where(F.col("stem").endswith("$")).agg(F.sum("toxic"), F.sum("clean")).first()
    all_toxic, all_clean = (float(s or 0) + 1 for s in sums)
    lift = (F.col("toxic") + 0.5) / all_toxic / ((F.col("clean") + 0.5) / all_clean)
    rows = (
        counted.where((F.col("toxic") >= MIN_CONTEXTS) & (lift >= MIN_LIFT))
        .select("stem", F.log(lift).alias("weight"))
        .orderBy(F.desc("weight"), "stem")
        .limit(MAX_STEMS)
        .collect()
    )
    stems = {r["stem"]: r["weight"] for r in rows}
    bare = Toxicity({}, (0.0,) * 4)

    def threats(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [bare.has_threat(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.bool_())], ["label", "threat"])

    counted = map_batches(sample, threats, "label int, threat boolean").groupBy("label", "threat").count().collect()
    threat = threat_weight({(r["label"], r["threat"]): r["count"] for r in counted})
    first = docs.sparkSession.sparkContext.broadcast(Toxicity(stems, (0.0,) * 4, threat))

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [first.value.evidence(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array([e[0] for e in found], pa.float64()), pa.array([e[1] for e in found], pa.float64()), batch.column("label")], ["total", "most", "label"])

    evidence = map_batches(sample, judge, "total double, most double, label int").collect()
    return Toxicity(stems, calibrate(sorted(((round(r["total"], 3), round(r["most"], 3)), r["label"]) for r in evidence)), threat)


def score(docs: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts match nothing and get the lowest score. Every row is scored by itself; an empty
    table gives no rows; rows without an id count as held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = shared.value
        scores = [own.score(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = map_batches(id_and_text(docs, id_col, text_col), step, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
