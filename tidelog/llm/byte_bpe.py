"""Byte-level BPE by ranks, run by a sentencepiece model that is written straight from the vocabulary."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidelog.llm.bpe import Memory, byte_chars
from tidelog.llm.common import Rows, id_and_text, release_memory

#: Fixed pattern of the rank files: what is encoded apart (a pre-token).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of texts taken at once, and pre-tokens remembered by a task, none longer than so many characters.
CHUNK_CHARS, REMEMBERED, REMEMBERED_CHARS = 500_000, 300_000, 100

# Field numbers and enumerations of the sentencepiece model format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE = 1, 2, 3
_NORMAL, _UNKNOWN = 1, 2
_MODEL_TYPE, _VOCAB_SIZE, _BPE = 3, 4, 2
_NAME, _DUMMY_PREFIX, _TRIM_BLANKS, _ESCAPE_BLANKS = 1, 3, 4, 5


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank; ranks run from 0 without gaps."""
    with open(path, "rb") as file:
        ranks = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in file if line.strip())}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    tokens = [ranks[i] for i in range(len(ranks))]
    if missing := {bytes([b]) for b in range(256)} - set(tokens):
        raise ValueError(f"{len(missing)} bytes have no token of their own")
    return tokens


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _text(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A BPE model whose piece k is token k, each byte written as its own character, with score -k.

    Pairs are merged by the score of what they give, so by rank; the normaliser is the identity, blanks included.
    The unknown piece, which the format demands, comes last and can't occur: every byte is a piece.
    """
    chars = byte_chars()
    model = bytearray()
    for rank, token in enumerate(tokens):
        name = "".join([chars[b] for b in token]).encode()
        score = _varint(_SCORE << 3 | 5) + struct.pack("<f", -rank)
        model += _text(_PIECES, _text(_PIECE, name) + score + _number(_TYPE, _NORMAL))
    model += _text(_PIECES, _text(_PIECE, b"<unk>") + _number(_TYPE, _UNKNOWN))
    model += _text(_TRAINER, _number(_MODEL_TYPE, _BPE) + _number(_VOCAB_SIZE, len(tokens) + 1))
    flags = b"".join(_number(f, 0) for f in (_DUMMY_PREFIX, _TRIM_BLANKS, _ESCAPE_BLANKS))
    model += _text(_NORMALIZER, _text(_NAME, b"identity") + flags)
    return bytes(model)


class ByteBpe:
    """The model of a rank file, and what it answered lately."""

    def __init__(self, path: str, pattern: str = PATTERN):
        import sentencepiece

        tokens = read_ranks(path)
        self.chars = dict(enumerate(byte_chars()))
        self.bytes_of = {ord(c): b for b, c in self.chars.items()}
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(tokens))
        self.pieces = [self.processor.id_to_piece(i) for i in range(len(tokens))]
        self.split = regex.compile(pattern).findall
        # A pre-token that is a token is that token, also where merging would not lead to it.
        names = ["".join([self.chars[b] for b in t]) for t in tokens]
        merged = self.processor.encode(names, num_threads=1)
        self.whole = {name: [i] for i, (name, ids) in enumerate(zip(names, merged, strict=True)) if ids != [i]}
        self.forget()

    def forget(self) -> None:
        self.known = Memory(REMEMBERED)

    def decoded(self, ids: Iterable[int]) -> bytes:
        """The bytes of the ids' pieces, by the inverse of the byte characters."""
        return "".join([self.pieces[i] for i in ids]).translate(self.bytes_of).encode("latin-1")

    def encode_names(self, names: list[str]) -> list[list[int]]:
        """Ids of pre-tokens written in byte characters."""
        found = self.processor.encode(names, num_threads=1)
        return [self.whole.get(name) or ids for name, ids in zip(names, found, strict=True)] if self.whole else found

    def encode_texts(self, texts: list[str]) -> list[tuple[int, str, bytes]]:
        """For each text: number of tokens, ids as text, decoded bytes."""
        split = [self.split(t) for t in texts]
        known = self.known
        own = {}
        for piece in set().union(*split):
            found = known.get(piece)
            own[piece] = found
        new = [p for p, found in own.items() if found is None]
        names = [p.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.chars) for p in new]
        for piece, ids in zip(new, self.encode_names(names), strict=True):
            own[piece] = answer = (",".join(map(str, ids)), self.decoded(ids), len(ids))
            if len(piece) <= REMEMBERED_CHARS:
                known.add(piece, answer)
        known.turn()
        out = []
        for pieces in split:
            each = [own[p] for p in pieces]
            out.append((sum([e[2] for e in each]), ",".join([e[0] for e in each]), b"".join([e[1] for e in each])))
        return out


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """The tables, made once in a worker."""
    return ByteBpe(path, pattern)


def encode(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    pattern: str = PATTERN,
    keep_text: bool = True,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256 (ids joined by commas), decoded_sha256 (of the bytes),
    and with ``keep_text`` also ids (an array) and decoded (binary).

    ``path`` is a rank file that all executors have. Null and empty texts have no tokens. Each document stands
    alone, so repeated rows, ties and extra columns make no difference; texts of any length are encoded whole. An
    empty table gives no rows.
    """
    kinds = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_text:
        kinds |= {"ids": pa.list_(pa.int32()), "decoded": pa.binary()}
        schema += ", ids array<int>, decoded binary"

    def step(tables: ByteBpe, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        rows, chunk, room = [], [], CHUNK_CHARS
        for text in texts:
            chunk.append(text)
            room -= len(text)
            if room <= 0:
                rows += map(answer, tables.encode_texts(chunk))
                chunk, room = [], CHUNK_CHARS
        if chunk:
            rows += map(answer, tables.encode_texts(chunk))
        made = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate([*kinds.values()][1:])]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], [*kinds])

    def answer(found: tuple[int, str, bytes]) -> tuple:
        n, ids, decoded = found
        row = (n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest())
        return (*row, [*map(int, ids.split(","))] if n else [], decoded) if keep_text else row

    def run(batches: Rows) -> Rows:
        tables = byte_bpe(path, pattern)
        try:
            for batch in batches:
                yield step(tables, batch)
        finally:
            tables.forget()
            release_memory()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
