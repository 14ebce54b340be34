"""Byte-pair encoding by speculation: longest matches first, merges only for words where they don't hold."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidelog.llm.common import Rows, id_and_text, release_memory

#: Fixed pattern of the vocabulary file: what is a word.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"
#: Characters for which Python's lower() and split() are the file's normaliser: printable ASCII, line ends, Latin.
PLAIN = re.compile("[^\\t\\n\\r -~¡-įĲ-ňŊ-ž]")
#: Chunks and words remembered by a task, none of them longer than so many characters; older ones are dropped by half.
REMEMBERED, REMEMBERED_CHARS = 400_000, 200


def byte_chars() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next free one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(0x100 + hidden.index(b)) if b in hidden else chr(b) for b in range(256)]


class Memory:
    """A dictionary of bounded size: entries not used since the last turn are forgotten."""

    def __init__(self, size: int = REMEMBERED):
        self.half, self.young, self.old = size // 2, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.young[key] = found
        return found

    def add(self, key, value) -> None:
        self.young[key] = value

    def turn(self) -> None:
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}


class WordBpe:
    """Tables of a vocabulary file with word ends; encodes words many at a time."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["end_of_word_suffix"] != END or model["unk_token"] or model["continuing_subword_prefix"]:
            raise ValueError("a BPE file with word ends is needed")
        vocab: dict[str, int] = model["vocab"]
        self.library = Tokenizer.from_file(path)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = [""] * (1 + max([*vocab.values(), *self.added.values()]))
        for name, i in [*vocab.items(), *self.added.items()]:
            self.names[i] = name
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = {p: k for k, p in enumerate(pairs)}
        self.vocab = vocab
        n = self.n = len(self.names)
        self.rank, self.left, self.right = (np.full(n, -1, np.int64) for _ in range(3))
        whole = np.array([vocab[a + b] for a, b in pairs])
        if len(set(whole.tolist())) < len(whole):
            raise ValueError("two merges make the same token")
        self.rank[whole] = np.arange(len(pairs))
        self.left[whole] = a = np.array([vocab[a] for a, _ in pairs])
        self.right[whole] = b = np.array([vocab[b] for _, b in pairs])
        order = np.argsort(a * n + b)
        self.pair_keys, self.pair_ranks = (a * n + b)[order], order
        # A proposal may only use tokens that merging their own characters gives back.
        sound = np.ones(n, bool)
        sound[whole] = self.compatible(a, b, np.arange(len(pairs)))
        for i in whole.tolist():
            sound[i] &= sound[self.left[i]] and sound[self.right[i]]
        self.proposed = {name: i for name, i in vocab.items() if sound[i]}
        sizes: dict[str, set[int]] = {}
        for name in self.proposed:
            bare = name.removesuffix(END)
            if len(bare) > 2:
                sizes.setdefault(bare[:3], {2, 1}).add(len(bare))
        #: Sizes of tokens by their first three characters, the largest first.
        self.sizes = {k: tuple(sorted(v, reverse=True)) for k, v in sizes.items()}
        self.split = regex.compile(PIECE)
        self.added_at = regex.compile("|".join(map(regex.escape, self.added)) or r"(?!)")
        self.chars = dict(enumerate(byte_chars()))
        self.forget()

    def forget(self, remembered: int = REMEMBERED) -> None:
        self.words, self.chunks = Memory(remembered), Memory(remembered)

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], np.iinfo(np.int64).max)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether merging ``a`` and ``b``'s characters leaves each of them whole (before rank ``until``).

        The merges inside both tokens are undone from the last to the first. At each moment one part of ``a``
        and one part of ``b`` face each other; a rule for the two that comes before the merges which used the
        parts up would have joined them across the border. Equal ranks go from left to right.
        """
        never = np.iinfo(np.int64).max - 1
        a, b = a.astype(np.int64), b.astype(np.int64)
        a_until = np.full(len(a), never) if until is None else until.astype(np.int64)
        b_until = a_until.copy() if until is None else a_until - 1
        ok, live = np.ones(len(a), bool), np.arange(len(a))
        while len(live):
            across = self._pair_rank(a, b)
            bad = (across < a_until) & (across <= b_until)
            ok[live[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            undo_a = ra > rb
            go = ~bad & ((ra >= 0) | (rb >= 0))
            a, b = np.where(undo_a, self.right[a], a)[go], np.where(undo_a, b, self.left[b])[go]
            a_until, b_until = np.where(undo_a, ra, a_until)[go], np.where(undo_a, b_until, rb)[go]
            live = live[go]
        return ok

    def propose(self, word: str) -> list[int]:
        """Longest sound token first, from the left."""
        got, i, n = [], 0, len(word)
        find, sizes = self.proposed.get, self.sizes.get
        while i < n:
            for size in sizes(word[i : i + 3], (2, 1)):
                j = i + size
                if j < n:
                    token = find(word[i:j])
                elif j == n:
                    token = find(word[i:] + END)
                else:
                    continue
                if token is not None:
                    break
            got.append(token)
            i = j
        return got

    def merge(self, word: str) -> list[int]:
        """Exact merging: the rule of lowest rank first, from the left."""
        if len(word) > 100:
            return self._merge_long(word)
        parts = [*word[:-1], word[-1] + END]
        find, never = self.merges.get, len(self.merges)
        ranks = [find(p, never) for p in zip(parts, parts[1:], strict=False)]
        while ranks and (low := min(ranks)) < never:
            i = ranks.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = find((parts[i - 1], parts[i]), never)
            if i < len(ranks):
                ranks[i] = find((parts[i], parts[i + 1]), never)
        return [self.vocab[p] for p in parts]

    def _merge_long(self, word: str) -> list[int]:
        """The same with a heap, for words where scanning for the lowest rank would be quadratic."""
        parts: list[str | None] = [*word[:-1], word[-1] + END]
        after, before = [*range(1, len(parts)), None], [None, *range(len(parts) - 1)]
        heap = [(r, i) for i in range(len(parts) - 1) if (r := self.merges.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else None
            if j is None or self.merges.get((parts[i], parts[j])) != r:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[j] is not None:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left is not None and right is not None:
                    new = self.merges.get((parts[left], parts[right]))
                    if new is not None:
                        heapq.heappush(heap, (new, left))
        return [self.vocab[p] for p in parts if p is not None]

    def encode_words(self, words: list[str]) -> tuple[list[list[int]], int]:
        """Token ids of each word (written in byte characters), and how many words needed merging."""
        proposals = [self.propose(w) for w in words]
        sizes = np.fromiter(map(len, proposals), np.int64, len(words))
        flat = np.fromiter((t for p in proposals for t in p), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        keys, back = np.unique(flat[inner] * self.n + flat[inner + 1], return_inverse=True)
        fails = ~self.compatible(keys // self.n, keys % self.n)[back]
        failing = np.unique(owner[inner[fails]]).tolist()
        for i in failing:
            proposals[i] = self.merge(words[i])
        return proposals, len(failing)

    def _remember(self, pieces_of: dict[str, list[str]]) -> dict[str, tuple[str, str, int]]:
        """The answers for new chunks of text, given as their words: ids and tokens as text, number of tokens."""
        new = [*dict.fromkeys(w for pieces in pieces_of.values() for w in pieces if self.words.get(w) is None)]
        own = {}
        for w, ids in zip(new, self.encode_words(new)[0], strict=True):
            own[w] = (" ".join(map(str, ids)), " ".join([self.names[i] for i in ids]), len(ids))
            if len(w) <= REMEMBERED_CHARS:
                self.words.add(w, own[w])
        found = {}
        for chunk, pieces in pieces_of.items():
            each = [own.get(w) or self.words.get(w) for w in pieces]
            found[chunk] = (" ".join([e[0] for e in each]), " ".join([e[1] for e in each]), sum(e[2] for e in each))
        return found

    def _plain_pieces(self, chunk: str) -> list[str]:
        found = self.split.findall(chunk)
        return found if chunk.isascii() else [w.encode().decode("latin-1").translate(self.chars) for w in found]

    def _library_pieces(self, text: str) -> list[str]:
        return [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]

    def encode_texts(self, texts: Iterable[str]) -> list[tuple[int, str, str]]:
        """For each text: number of tokens, ids as text, decoded text."""
        segments = []  # of each text: added tokens, and chunks by blanks or whole odd segments
        for text in texts:
            parts, at = [], 0
            for m in self.added_at.finditer(text) if "<|" in text else ():
                parts += [(False, text[at : m.start()]), (True, m.group())]
                at = m.end()
            segments.append([*parts, (False, text[at:] if at else text)])
        chunks: list[list] = []
        unknown: dict[str, list[str]] = {}
        known = self.chunks
        for parts in segments:
            row: list = []
            for special, part in parts:
                if special:
                    row.append((str(self.added[part]), part, 1))
                elif PLAIN.search(part):
                    row.append(self._remember({"": self._library_pieces(part)})[""])
                else:
                    row += part.lower().split()
            for c in {c for c in row if c.__class__ is str}:
                if c not in unknown and known.get(c) is None:
                    unknown[c] = self._plain_pieces(c)
            chunks.append(row)
        new = self._remember(unknown)
        answers = []
        for row in chunks:
            each = [c if c.__class__ is tuple else new.get(c) or known.get(c) for c in row]
            each = [e for e in each if e[2]]
            ids = " ".join([e[0] for e in each])
            answers.append((ids.count(" ") + 1 if ids else 0, ids, " ".join([e[1] for e in each])))
        known.young.update((c, e) for c, e in new.items() if len(c) <= REMEMBERED_CHARS)
        known.turn()
        self.words.turn()
        return answers


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """The tables, made once in a worker."""
    return WordBpe(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, keep_text: bool = True, remembered: int = REMEMBERED) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``keep_text`` ids and decoded.

    A task remembers the answers of so many words, which costs some 200 MB of its worker at the default.

    ``path`` is a vocabulary file that all executors have. Null and empty texts have no tokens. Each document
    stands alone, so repeated rows, ties and extra columns make no difference; an empty table gives no rows.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        tables = word_bpe(path)
        texts = batch.column("text").to_pylist()
        n, ids, decoded = [], [], []
        for at in range(0, len(texts), 500):
            for count, own, text in tables.encode_texts(texts[at : at + 500]):
                n.append(count)
                if keep_text:
                    ids.append((own, hashlib.sha256(own.encode()).hexdigest()))
                    decoded.append((text, hashlib.sha256(text.encode()).hexdigest()))
                else:
                    ids.append(hashlib.sha256(own.encode()).hexdigest())
                    decoded.append(hashlib.sha256(text.encode()).hexdigest())
        columns = [batch.column("doc_id"), pa.array(n, pa.int64())]
        if keep_text:
            for pairs in (ids, decoded):
                columns += [pa.array([h for _, h in pairs], pa.string()), pa.array([t for t, _ in pairs], pa.string())]
        else:
            columns += [pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names)

    kinds = {"doc_id": "long", "n_tokens": "long", "ids_sha256": "string", "ids": "string", "decoded_sha256": "string", "decoded": "string"}
    names = [c for c in kinds if keep_text or c not in ("ids", "decoded")]

    def run(batches: Rows) -> Rows:
        word_bpe(path).forget(remembered)
        try:
            yield from map(step, batches)
        finally:
            word_bpe(path).forget()
            release_memory()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names))
