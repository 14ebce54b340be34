"""Token ids in coded files: documents in order of their id, blocks that can be read alone."""

from __future__ import annotations

import codecs
import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm import range_coder
from tidelog.llm.bpe import PLAIN, byte_chars
from tidelog.llm.common import Rows, id_and_text, map_batches
from tidelog.session import scratch_path

#: Ids after which a group of blocks is closed, at the next end of a document.
GROUP = range_coder.BLOCK * range_coder.DECODE_LANES
END_ID = 2
#: If a task remembers more words than this, it forgets those that it has not just met.
REMEMBERED = 500_000
#: Words asked for in one text, and bytes of texts that are encoded at once (whole texts, one more than that at most).
ASKED, SLICE_BYTES = 1000, 8 << 20
#: Texts that can't be cut: other than printable ASCII, line ends and Latin, or a blank or line end before white space or the end.
_WHOLE = PLAIN.pattern + r"|[ \n](?:[\t\n\r ]|\z)"
#: The character that stands for each byte in the vocabulary file, but for the line ends between words.
_SHOWN = "".join("\n" if i == 10 else c for i, c in enumerate(byte_chars()))

#: The file format, as Parquet columns: each row is a group, with the documents that it holds.
GROUPS = (
    "part int, group int, n_ids long, doc_ids array<long>, doc_sizes array<long>, "
    "blocks array<struct<n:int, crc32:long, code:binary>>"
)
_BLOCKS = pa.list_(pa.struct([("n", pa.int32()), ("crc32", pa.int64()), ("code", pa.binary())]))


class ByteBpe:
    """The library's encoding, asked once for each new word.

    Texts are cut before each blank or line end: where neither white space nor the end follows, GPT-2's pattern begins
    a new piece there. A text's beginning is made alike by a line end, whose id is then left out. Files with another
    pattern are asked for whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.library, self.letters = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for own in (self.library, self.letters):
            own.no_truncation()
            own.no_padding()
        # A blank and letters are one piece of the pattern, so words of letters need no pattern.
        self.letters.pre_tokenizer = CharDelimiterSplit("\n")
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        size = self.library.get_vocab_size()
        if size > (1 << 16) - 1:
            raise ValueError("ids of 16 bits are supported")
        file = json.loads(self.library.to_str())
        kind = file["pre_tokenizer"] or {}
        self.cuts = (
            file["normalizer"] is None
            and (kind.get("type"), kind.get("add_prefix_space"), kind.get("use_regex")) == ("ByteLevel", False, True)
            and all(self.library.token_to_id(c) is not None for c in byte_chars())
        )
        #: Whether a token begins with a blank or line end (which byte-level files write as U+0120 and U+010A).
        self.opens = np.array([(self.library.id_to_token(i) or "").startswith(("\u0120", "\u010a")) for i in range(size)])
        self.stop, self.comma = (self.library.token_to_id(c) or 0 for c in ".,")
        self._remember(pa.array([""]), np.zeros(1, np.int32), np.zeros(0, np.uint16))

    def _ask(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint16) for e in found]

    def _ask_letters(self, texts: list[str]) -> list[np.ndarray]:
        shown = [codecs.charmap_decode(t.encode(), "strict", _SHOWN)[0] for t in texts]
        found = self.letters.encode_batch_fast(shown, add_special_tokens=False)
        return [np.array(e.ids, np.uint16) for e in found]

    def _remember(self, words: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Words, and their ids one after the other."""
        self.words, self.sizes, self.ids = words, sizes, ids

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where different words lie among the remembered ones.

        New ones are asked for many at a time; the answers are cut where a token has the blank or line end before a word.
        """
        if len(self.words) > REMEMBERED:
            met = pc.is_in(self.words, value_set=pa.concat_arrays([words, pa.array([""])]))
            kept = met.to_numpy(zero_copy_only=False)
            self._remember(self.words.filter(met), self.sizes[kept], self.ids[np.repeat(kept, self.sizes)])
        place = pc.index_in(words, value_set=self.words)
        new = place.is_null()
        words = words.filter(new)
        plain = pc.utf8_is_alpha(words)
        letters, rest = words.filter(plain), words.filter(pc.invert(plain))
        before = pc.if_else(pc.starts_with(rest, "\n"), "", " ")
        asked = [
            *self._ask_letters(_joined(pc.binary_join_element_wise(" ", letters, ""), "\n")),
            *self._ask(_joined(pc.binary_join_element_wise(before, rest, ""), "")),
        ]
        ids = np.concatenate([*asked, np.zeros(0, np.uint16)])
        at = np.flatnonzero(self.opens[ids])
        if len(at) != len(words):
            raise ValueError("the vocabulary's pieces don't begin at blanks and line ends")
        order = np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable")
        place = place.fill_null(0).to_numpy().copy()
        place[np.flatnonzero(new.to_numpy(zero_copy_only=False))[order]] = len(self.words) + np.arange(len(words))
        self._remember(
            pa.concat_arrays([self.words, letters, rest]),
            np.concatenate([self.sizes, np.diff(np.append(at, len(ids))).astype(np.int32)]),
            np.concatenate([self.ids, ids]),
        )
        return place

    def _ids_of(self, words: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and where those of each end.

        A stop or comma after a letter, at the end of a word, is a token of its own, so it is cut off.
        """
        names, codes = words.dictionary, words.indices.to_numpy()
        ended = pc.match_substring_regex(names, r"\pL[.,]\z")
        bare = pc.if_else(ended, pc.utf8_slice_codeunits(names, 0, -1), names).dictionary_encode()
        place = self._places(bare.dictionary)[bare.indices.to_numpy()]
        ended = ended.to_numpy(zero_copy_only=False)
        mark = np.where(pc.ends_with(names, ",").to_numpy(zero_copy_only=False), self.comma, self.stop)
        # Arrow's texts are under 2 GB, so 32 bits do.
        begins = (np.cumsum(self.sizes, dtype=np.int32) - self.sizes)[place]
        took = (self.sizes[place] + ended)[codes]
        ends = np.cumsum(took, dtype=np.int32)
        at = np.repeat(begins[codes] - (ends - took), took)
        at += np.arange(len(at), dtype=np.int32)
        ids = np.append(self.ids, np.uint16(0))[at]
        marked = ended[codes]
        ids[ends[marked] - 1] = mark[codes[marked]]
        return ids, ends

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """The ids of each text, as 16-bit numbers."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string())
        if not self.cuts:
            return self._ask(texts.to_pylist())
        marked = pc.binary_join_element_wise("\n", texts, "")
        whole = pc.match_substring_regex(marked, _WHOLE)
        for added in self.added:
            whole = pc.or_(whole, pc.match_substring(marked, added))
        alone = iter(self._ask(texts.filter(whole).to_pylist()))
        pieces = pc.split_pattern(pc.replace_substring(marked.filter(pc.invert(whole)), "\n", " \n"), " ")
        ids, ends = self._ids_of(pieces.flatten().dictionary_encode())
        ends = np.append(0, ends)[pieces.offsets.to_numpy()].tolist()
        cut = (ids[a + 1 : b] for a, b in zip(ends, ends[1:], strict=False))
        return [next(alone if w else cut) for w in whole.to_numpy(zero_copy_only=False).tolist()]


def _joined(words: pa.Array, between: str) -> list[str]:
    """Texts of :data:`ASKED` words each."""
    cuts = pa.array([*range(0, len(words), ASKED), len(words)], pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(cuts, words), between).to_pylist()


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive rows of some :data:`SLICE_BYTES` each."""
    at = pc.binary_length(texts).to_numpy().cumsum() // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(texts)]
    yield from zip(cuts, cuts[1:], strict=False)


def write(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", *, end_id: int = END_ID) -> None:
    """Encode all texts and write them in ascending order of doc_id (null first), one file for each range of ids.

    ``path`` is a folder that all executors share. A file is a run of groups; a group holds whole documents and
    its ids in blocks that are coded, and checked by crc32, each for itself. A lost task is simply written again.
    """
    rows = id_and_text(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Rows) -> Rows:
        part, group = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        names: list = []
        n = 0

        def close() -> pa.RecordBatch:
            blocks = [{"n": k, "crc32": c, "code": code} for k, c, code in range_coder.encode(np.concatenate(ids))]
            columns = [[part], [group], [n], [names], [[len(x) for x in ids]]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([blocks], _BLOCKS)], ["part", "group", "n_ids", "doc_ids", "doc_sizes", "blocks"])

        end = np.array([end_id], np.uint16)
        for batch in batches:
            texts, keys = batch.column("text"), batch.column("doc_id").to_pylist()
            for at, until in _slices(texts):
                encoded = byte_bpe(vocabulary).encode(texts[at:until])
                for key, own in zip(keys[at:until], encoded, strict=True):
                    ids.append(np.concatenate([own, end]))
                    names.append(key)
                    n += len(own) + 1
                    if n >= GROUP:
                        yield close()
                        ids, names, n, group = [], [], 0, group + 1
        if ids:
            yield close()

    rows.mapInArrow(run, GROUPS).write.parquet(path)


def _starts(groups: DataFrame) -> DataFrame:
    """(part, group, begin): the ids in all groups before. Sums by file first, so that no window holds all groups."""
    sizes = groups.select("part", "group", "n_ids")
    files = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("file_begin"))
    inside = Window.partitionBy("part").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", "group", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("own_begin"))
    return sizes.join(files, "part").select("part", "group", (F.col("file_begin") + F.col("own_begin")).alias("begin"))


def read(spark: SparkSession, path: str, *, ids: bool = True) -> DataFrame:
    """Decode the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32, and ``ids`` if asked for.

    Every block's checksum is verified. ``ids_crc32`` is over the ids as little-endian 32-bit numbers.
    """
    groups = spark.read.schema(GROUPS).parquet(path)

    def documents(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            blocks = row.column("blocks").flatten()
            codes = (blocks.field(k).to_pylist() for k in ("n", "crc32", "code"))
            got = range_coder.decode(list(zip(*codes, strict=True)))
            sizes = np.array(row.column("doc_sizes").flatten().to_pylist(), np.int64)
            ends = np.cumsum(sizes)
            crcs = [zlib.crc32(got[a:b].tobytes()) for a, b in zip(ends - sizes, ends, strict=True)]
            n = len(sizes)
            columns = [
                pa.array(np.repeat(row.column("part").to_numpy(), n), pa.int32()),
                pa.array(np.repeat(row.column("group").to_numpy(), n), pa.int32()),
                row.column("doc_ids").flatten(),
                pa.array(ends - sizes, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(crcs, pa.int64()),
            ]
            if ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(got.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["part", "group", "doc_id", "offset", "n_tokens", "ids_crc32", *(["ids"] if ids else [])]
    kinds = ["int", "int", "long", "long", "long", "long", *(["array<int>"] if ids else [])]
    schema = ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True))
    rows = map_batches(groups, lambda batch: pa.Table.from_batches(documents(batch)), schema)
    rows = rows.join(_starts(groups), ["part", "group"])
    return rows.select("doc_id", (F.col("begin") + F.col("offset")).alias("start"), *names[4:])


def write_and_read(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", *, end_id: int = END_ID) -> DataFrame:
    """One row per document from freshly written files: doc_id, start, n_tokens (with the end id), ids_crc32.

    Null and empty texts have the end id alone. Rows of the same doc_id lie side by side in the order of their
    texts. An empty table gives files without groups, and no rows.
    """
    path = scratch_path(docs.sparkSession, "token-files")
    write(docs, path, vocabulary, id_col, text_col, end_id=end_id)
    return read(docs.sparkSession, path, ids=False)
