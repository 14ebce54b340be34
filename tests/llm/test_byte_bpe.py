"""Rank-file BPE through a written sentencepiece model, against tiktoken."""

import base64
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from tests.llm.test_contracts import ODD_ROWS, SF, answers, frame
from tidelog.llm import byte_bpe, queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
COLUMNS = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@pytest.fixture(scope="module")
def tables():
    return byte_bpe.ByteBpe(PATH)


def answer(tables, text):
    (n, ids, decoded), wanted = tables.encode_texts([text])[0], brute.ranks(PATH).encode_ordinary(text)
    assert decoded == text.encode() and ids == ",".join(map(str, wanted)) and n == len(wanted)


def test_pattern_is_the_published_one():
    assert byte_bpe.PATTERN == public_tokenizers.PATTERN


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=200))
def test_any_text(tables, text):
    answer(tables, text)


def test_characters_of_all_planes(tables):
    rng = random.Random(4)
    chars = [chr(c) for c in rng.sample([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], 20_000)]
    texts = ["a" + c + "1" + c + " " + c + c + "!" + c + "  " + c for c in chars]
    wanted = brute.ranks(PATH).encode_ordinary_batch(texts)
    assert [r[1] for r in tables.encode_texts(texts)] == [",".join(map(str, w)) for w in wanted]


def test_every_token_alone(tables):
    library = brute.ranks(PATH)
    texts = [t.decode() for t in library.token_byte_values() if t.isascii()]
    assert [r[1] for r in tables.encode_texts(texts)] == [",".join(map(str, library.encode_ordinary(t))) for t in texts]


@pytest.mark.parametrize("text", ["x" * 50_000, " " * 20_000 + "y", "ab" * 30_000, "ß" * 9_999, "1" * 30_000])
def test_very_long_pre_tokens(tables, text):
    answer(tables, text)


def test_tokens_that_merging_does_not_reach(tmp_path):
    """A pre-token that is a token is that token, even without the merges towards it."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abcd": 256, b" ab": 257, b"cd": 258}
    path = tmp_path / "some.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    library = tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = "abcd abcd ab abcde 'll\n\n x"
    assert byte_bpe.ByteBpe(str(path)).encode_texts([text])[0][1] == ",".join(map(str, library.encode_ordinary(text)))


@pytest.mark.parametrize("lines, message", [([b"AA== 1"], "gaps"), ([b"AA== 0"], "no token of their own")])
def test_unfit_files(tmp_path, lines, message):
    path = tmp_path / "some.tiktoken"
    path.write_bytes(b"\n".join(lines))
    with pytest.raises(ValueError, match=message):
        byte_bpe.read_ranks(str(path))


def test_rows(spark):
    got = byte_bpe.encode(frame(spark, ODD_ROWS), PATH, keep_text=False)
    assert answers(got, *COLUMNS) == brute.byte_bpe(ODD_ROWS, PATH)


def test_texts_come_out(spark):
    row = byte_bpe.encode(frame(spark, [(1, "Ünï code 12"), (2, None)]), PATH).orderBy("doc_id").collect()
    assert [bytes(r["decoded"]) for r in row] == ["Ünï code 12".encode(), b""]
    assert row[0]["ids"] == brute.ranks(PATH).encode_ordinary("Ünï code 12") and row[1]["ids"] == []


def test_empty_table(spark):
    assert byte_bpe.encode(frame(spark, []), PATH).collect() == []


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert answers(queries.op12_byte_bpe(spark, SF), *COLUMNS) == brute.byte_bpe(rows, PATH)
