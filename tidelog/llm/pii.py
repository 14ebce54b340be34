"""Personal data: fixed finders, and further spans that voting labelers and a trained classifier accept."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import id_and_text, map_batches
from tidelog.session import stored

Span = tuple[int, int, int]  # start, kind, end

# Fixed patterns of the base kinds. A match of _IP never begins inside a run of digits; saying so keeps long runs linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

BASE_KINDS = ("email", "ip", "card", "phone")
#: What may be personal data beyond them; whether it is, the classifier says.
LOOSE = {
    "email_words": re.compile(
        r"[A-Za-z0-9._-]{2,40}(?:\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]{2,40}\x20?(?:\[dot\]|\(dot\)|\.)\x20?"
        r"|\x20at\x20[A-Za-z0-9-]{2,40}\x20dot\x20)[A-Za-z]{2,10}"
    ),
    "phone_local": re.compile(r"(?<![0-9+.-])\(?0[0-9]{1,4}\)?[\x20./-][0-9]{2,4}(?:[\x20./-]?[0-9]{2,4}){1,3}(?![0-9])"),
    "id_number": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "birth_date": re.compile(r"(?<![0-9])[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}(?![0-9])"),
}
KINDS = (*BASE_KINDS, *LOOSE)

# Gazetteers: words that stand before personal data, and words that stand before other numbers.
NEAR_WORDS = frozenset("mail email e-mail contact contacto kontakt write phone tel telephone telefon teléfono téléphone call mobile handy ip address host card credit karte carte tarjeta ssn social iban account konto compte cuenta born birth geboren né née nacido".split())
FAR_WORDS = frozenset("version page seite página isbn issn order invoice rechnung facture factura item no nr build chapter section line figure table price total".split())
CONTEXT = 40
#: Labelers in the order of their votes: 1 for, -1 against, 0 no opinion.
LABELERS = ("shape", "checksum", "near_words", "far_words", "border", "variety")
#: Rounds of expectation maximisation and of the classifier's fit.
EM_ROUNDS, FIT_ROUNDS = 40, 300
ACCEPT = 0.5


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[::-2]))) % 10 == 0


def iban_valid(text: str) -> bool:
    bare = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@`` and a domain, from each ``@`` backwards: its local part has no other ``@``."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if domain and start < at:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """The base kinds, leftmost and not overlapping within a kind."""
    found: list[Span] = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return found


def loose_spans(text: str) -> list[Span]:
    return [(m.start(), len(BASE_KINDS) + k, m.end()) for k, p in enumerate(LOOSE.values()) for m in p.finditer(text)]


def votes(text: str, span: Span) -> tuple[int, ...]:
    """What the labelers say of a candidate."""
    start, kind, end = span
    name, own = KINDS[kind], text[start:end]
    digits = _NOT_DIGIT.sub("", own)
    before = set(re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)*", text[max(0, start - CONTEXT) : start].lower()))
    shape = {"email": 1, "ip": 1, "phone": 1, "card": 1, "iban": 1, "id_number": 1 if digits[:3] not in ("000", "666") and digits[:1] != "9" and digits[3:5] != "00" else -1}
    checksum = {"card": lambda: luhn(digits), "iban": lambda: iban_valid(own), "birth_date": lambda: 1 <= int(re.split("[./-]", own)[0]) <= 31 and int(re.split("[./-]", own)[1]) <= 31}
    letters = text[start - 1 : start] + text[end : end + 1]
    return (
        shape.get(name, 0),
        0 if name not in checksum else 1 if checksum[name]() else -1,
        1 if before & NEAR_WORDS else 0,
        -1 if before & FAR_WORDS else 0,
        -1 if any(c.isalnum() for c in letters) else 1,
        0 if not digits else 1 if len(set(digits)) > 3 else -1,
    )


def span_features(text: str, span: Span) -> tuple[int, ...]:
    """What the classifier sees: kind, length, digits, separators, and the characters around; few values each."""
    start, kind, end = span
    own = text[start:end]
    around = text[start - 1 : start], text[end : end + 1]
    return (
        kind,
        min(9, (end - start) // 4),
        min(9, sum(c.isdigit() for c in own) // 3),
        sum((c in own) << i for i, c in enumerate(" -.@")),
        *(0 if not c else 1 if c.isspace() else 2 if c.isalnum() else 3 for c in around),
        1 if {*re.findall(r"[^\W\d_]+", text[max(0, start - CONTEXT) : start].lower())} & NEAR_WORDS else 0,
    )


FEATURE_SIZES = (len(KINDS), 10, 10, 16, 4, 4, 2)


@dataclass(frozen=True)
class SpanModel:
    """``reliability``: for each labeler the chances of its votes -1, 0, 1 on wrong and on right spans."""

    prior: float
    reliability: np.ndarray
    weights: np.ndarray

    def chance(self, features: tuple[int, ...]) -> float:
        at = np.cumsum([0, *FEATURE_SIZES[:-1]]) + np.array(features)
        return float(1 / (1 + np.exp(-self.weights[-1] - self.weights[at].sum())))


def fit(patterns: list[tuple[tuple[int, ...], tuple[int, ...], int]]) -> SpanModel:
    """From counted patterns (votes, features, count).

    Expectation maximisation estimates how often each labeler votes which way on right and on wrong spans, and
    with that the chance that a pattern is right. Those chances are the targets of a logistic regression on the features.
    """
    n_labelers = len(LABELERS)
    seen = np.array([[v + 1 for v in p[0]] for p in patterns], np.int64).reshape(-1, n_labelers)
    count = np.array([p[2] for p in patterns], np.float64)
    # Start: labelers are better than chance; this also decides which of the two classes is which.
    start = np.array([[0.45, 0.35, 0.2], [0.1, 0.3, 0.6]])
    table, prior = np.repeat(start[None], n_labelers, 0), 0.5
    rows = np.arange(n_labelers)
    right = np.zeros(len(seen))
    for _ in range(EM_ROUNDS):
        log = np.log(table[rows[None, :], :, seen]).sum(axis=1) if len(seen) else np.zeros((0, 2))
        log = log + np.log([1 - prior, prior])
        right = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
        prior = float(np.clip((count @ right + 5) / (count.sum() + 10), 0.02, 0.98))
        for c, w in ((0, count * (1 - right)), (1, count * right)):
            for k in range(n_labelers):
                # The start weighs like 20 spans, so labelers that hardly vote keep it.
                table[k, c] = (np.bincount(seen[:, k], w, 3) + 20 * start[c]) / (w.sum() + 20)
    offsets = np.cumsum([0, *FEATURE_SIZES[:-1]])
    at = np.array([p[1] for p in patterns], np.int64).reshape(-1, len(FEATURE_SIZES)) + offsets
    weights, squares = np.zeros(sum(FEATURE_SIZES) + 1), np.full(sum(FEATURE_SIZES) + 1, 1e-6)
    share = count / max(count.sum(), 1)
    for _ in range(FIT_ROUNDS):
        p = 1 / (1 + np.exp(-weights[-1] - weights[at].sum(axis=1)))
        g = share * (p - right)
        step = np.bincount(at.reshape(-1), np.repeat(g, at.shape[1]), len(weights)).astype(np.float64)
        step[-1] = g.sum()
        step += 1e-4 * weights
        squares += step * step
        weights -= 0.3 * step / np.sqrt(squares)
    return SpanModel(prior, table, weights)


_CANDIDATES = (
    "doc_id long, found array<struct<start:int, kind:int, end:int, votes:array<int>, features:array<int>>>"
)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its candidate spans, the labelers' votes and the classifier's features."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("votes", pa.list_(pa.int32())), ("features", pa.list_(pa.int32()))]))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text) + loose_spans(text)
            rows.append([{"start": s[0], "kind": s[1], "end": s[2], "votes": votes(text, s), "features": span_features(text, s)} for s in spans])
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "found"])

    return map_batches(id_and_text(docs, id_col, text_col), step, _CANDIDATES)


def train(found: DataFrame) -> SpanModel:
    """Fit on the candidates of all documents, counted by pattern; only the patterns come to the driver.

    Their number is bounded by the few values of each vote and feature, not by the table.
    """
    counted = found.select(F.explode("found").alias("c")).groupBy("c.votes", "c.features").agg(F.count("*").alias("n"))
    rows = [(tuple(r["votes"]), tuple(r["features"]), r["n"]) for r in counted.toLocalIterator()]
    return fit(sorted(rows))


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans.

    Base spans always stay; of the other candidates those stay that overlap no base span and that the
    classifier finds likelier right than wrong. Spans are in code points, end exclusive. Null and empty texts
    have none; repeated rows are answered one by one; without any candidate the model stays at its start; an
    empty table gives no rows.
    """
    found = stored(candidates(docs, id_col, text_col), "candidates")
    shared = docs.sparkSession.sparkContext.broadcast(train(found))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, base, spans, counts, n_spans = shared.value, [], [], [[] for _ in BASE_KINDS], []
        for row in batch.column("found").to_pylist():
            own = [(c["start"], c["kind"], c["end"]) for c in row if c["kind"] < len(BASE_KINDS)]
            more = [
                (c["start"], c["kind"], c["end"])
                for c in row
                if c["kind"] >= len(BASE_KINDS)
                and not any(a < c["end"] and c["start"] < b for a, _, b in own)
                and model.chance(tuple(c["features"])) > ACCEPT
            ]
            base.append(hashlib.sha256(_listed(own).encode()).hexdigest())
            spans.append(_listed(own + more))
            n_spans.append(len(own + more))
            for k, n in enumerate(counts):
                n.append(sum(s[1] == k for s in own))
        columns = [batch.column("doc_id"), *(pa.array(n, pa.int64()) for n in counts), pa.array(base, pa.string()), pa.array(spans, pa.string()), pa.array(n_spans, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", *names, "base_sha256", "spans", "n_spans"])

    names = [f"n_{k}" for k in BASE_KINDS]
    return map_batches(found, step, "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", base_sha256 string, spans string, n_spans long")
