"""Secrets in texts, found through a trigram index and verified by the rules' patterns."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from re import _constants as ops
from re import _parser

import pyarrow as pa
from pyspark.sql import DataFrame

from tidelog.llm.common import id_and_text, map_batches

#: Strings of an exactly known part of a pattern, at most; a larger part counts as unknown.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``accept`` judges a match; ``flags`` as in ``re``. A base rule counts in the digest columns."""

    kind: str
    pattern: str
    accept: Callable[[re.Match], bool] = lambda m: True
    flags: int = 0
    base: bool = False


# Fixed patterns; the base ones are given. A run of 32 or more is what remains of all runs after that condition.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8, re.I | re.A, True),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16, 0, True),
    Rule("hex", r"[0-9a-f]{32,}", base=True),
)
EXTRA_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    # Only from the beginning of a part: repeated "eyJ" would be tried from each of them.
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("url_login", r"://[^\s/:@]{1,64}:[^\s/:@]{3,64}@"),
)
RULES = BASE_RULES + EXTRA_RULES

#: A Boolean query in disjunctive form: any of these sets of trigrams must be there whole. None: no condition.
Query = frozenset[frozenset[str]] | None


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _any(a: Query, b: Query) -> Query:
    return None if a is None or b is None else _least(a | b)


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    if len(a) * len(b) > MAX_STRINGS:
        return a  # leaving a condition out only adds candidates
    return _least(frozenset(x | y for x in a for y in b))


def _least(sets: frozenset[frozenset[str]]) -> Query:
    """Without alternatives that ask for more than another one does."""
    return frozenset(s for s in sets if not any(o < s for o in sets))


def _of_strings(strings: set[str]) -> Query:
    if not strings or any(len(s) < 3 for s in strings):
        return None
    return _least(frozenset(_trigrams(s) for s in strings))


def _charset(items: Sequence) -> set[str] | None:
    found: set[str] = set()
    for op, arg in items:
        if op is ops.LITERAL:
            found.add(chr(arg).lower())
        elif op is ops.RANGE and arg[1] - arg[0] < MAX_STRINGS:
            found |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return found


def _derive(nodes: Sequence) -> tuple[set[str] | None, Query]:
    """For a parsed pattern: all strings it matches, in lower case, if few; and a query its matches fulfil."""
    exact: set[str] | None = {""}  # the strings of the part since the last unknown piece
    whole, query = True, None
    for op, arg in nodes:
        own, need = None, None
        if op is ops.LITERAL:
            own = {chr(arg).lower()}
        elif op is ops.IN:
            own = _charset(arg)
        elif op is ops.AT:
            own = {""}
        elif op is ops.SUBPATTERN:
            own, need = _derive(arg[-1])
        elif op is ops.BRANCH:
            each = [_derive(b) for b in arg[1]]
            known = [e for e, _ in each]
            own = set().union(*known) if all(e is not None for e in known) else None
            if own is None:
                need = each[0][1] if each[0][0] is None else _of_strings(each[0][0])
                for e, q in each[1:]:
                    need = _any(need, q if e is None else _of_strings(e))
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT):
            low, high, inner = arg
            e, q = _derive(inner)
            if e is not None and high <= 2:
                own = set()
                for n in range(low, high + 1):
                    powers = {""}
                    for _ in range(n):
                        powers = {p + x for p in powers for x in e}
                    own |= powers
            elif low >= 1:
                need = q if e is None else _of_strings(e)
        if own is not None and len(exact) * len(own) <= MAX_STRINGS:
            exact = {a + b for a in exact for b in own}
            continue
        query = _both(query, _of_strings(exact))
        query = _both(query, need if own is None else _of_strings(own))
        whole, exact = False, {""}
    return (exact, None) if whole else (None, _both(query, _of_strings(exact)))


def trigram_query(rule: Rule) -> Query:
    """Trigrams, in lower case, that every match of the rule has; None if the pattern demands none."""
    exact, query = _derive(_parser.parse(rule.pattern, rule.flags).data)
    return query if exact is None else _of_strings(exact)


class TrigramIndex:
    """Posting lists over the texts of one batch: trigram to the places of the texts that have it.

    The index is cut by documents: each batch of the table has its own, in the task that reads it, so building
    it moves nothing and a candidate is verified where its text is. Only trigrams that some query asks for have lists.
    """

    def __init__(self, texts: list[str], grams: set[str]):
        self.n = len(texts)
        folded = [t.lower() for t in texts]
        self.postings = {g: {i for i, t in enumerate(folded) if g in t} for g in grams}

    def candidates(self, query: Query) -> list[int]:
        """Texts that fulfil the query, the shortest posting lists first; all texts if it is None."""
        if query is None:
            return list(range(self.n))
        found: set[int] = set()
        for grams in query:
            lists = sorted((self.postings[g] for g in grams), key=len)
            found |= set.intersection(*lists) if lists else set()
        return sorted(found)


def _listed(spans: list[tuple[int, int, int]], kinds: list[str]) -> str:
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, extra: Sequence[Rule] = EXTRA_RULES) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    A rule looks only into texts that fulfil its trigram query; one without mandatory trigrams looks into all.
    Spans are the whole matches in code points, end exclusive, leftmost and not overlapping within a kind; kinds
    may overlap. Null and empty texts have none. Every row is answered by itself; an empty table gives no rows.
    """
    rules = (*BASE_RULES, *extra)
    kinds = [r.kind for r in rules]
    queries = [trigram_query(r) for r in rules]
    grams = {g for q in queries if q is not None for s in q for g in s}

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        index = TrigramIndex(texts, grams)
        for k, (rule, query) in enumerate(zip(rules, queries, strict=True)):
            search = re.compile(rule.pattern, rule.flags).finditer
            for i in index.candidates(query):
                found[i] += [(m.start(), k, m.end()) for m in search(texts[i]) if rule.accept(m)]
        base = [[s for s in spans if rules[s[1]].base] for spans in found]
        counts = [[sum(s[1] == k for s in spans) for spans in base] for k in range(len(BASE_RULES))]
        digests = [hashlib.sha256(_listed(spans, kinds).encode()).hexdigest() for spans in base]
        columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts)]
        columns += [pa.array(digests, pa.string()), pa.array([_listed(s, kinds) for s in found], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", *names, "base_sha256", "spans"])

    names = [f"n_{r.kind}" for r in BASE_RULES]
    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", base_sha256 string, spans string"
    return map_batches(id_and_text(docs, id_col, text_col), step, schema)
