"""Parts of the operators, learned models, and what the contracts leave open."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.test_contracts import BYTES, ITEMS, ODD_ROWS, PASSAGE, WORDS, answers, frame, items
from tidelog.llm import bpe, decontaminate, exact_dedup, pii, quality, range_coder, secret_scan, token_files, toxicity
from tidelog.llm.common import components

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables():
    return bpe.WordBpe(WORDS)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_bpe_equals_the_library(tables, text):
    ids = tables.library.encode(text, add_special_tokens=False).ids
    n, own, decoded = tables.encode_texts([text])[0]
    assert (n, own) == (len(ids), " ".join(map(str, ids)))
    assert decoded == tables.library.decode(ids, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abehinorst", min_size=1, max_size=30))
def test_speculation_fails_exactly_where_merging_differs(tables, word):
    proposed = tables.propose(word)
    pairs = np.array(list(zip(proposed, proposed[1:], strict=False)), np.int64).reshape(-1, 2)
    assert bool(tables.compatible(pairs[:, 0], pairs[:, 1]).all()) == (proposed == tables.merge(word))
    assert tables.merge(word) == tables._merge_long(word)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_byte_bpe_equals_the_library(texts):
    own = token_files.byte_bpe(BYTES)
    want = [e.ids for e in own.library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in own.encode(texts)] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aZéß1.,'s-  \n\n\t\r", max_size=30), max_size=5))
def test_byte_bpe_cuts_texts_where_the_library_does(texts):
    own = token_files.byte_bpe(BYTES)
    want = [e.ids for e in own.library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in own.encode(texts)] == want


class Counted:
    """A tokenizer that counts the words it is given."""

    def __init__(self, library):
        self.library, self.words = library, 0

    def encode_batch_fast(self, texts, **options):
        self.words += sum(len(re.findall(r"\w+", t)) for t in texts)
        return self.library.encode_batch_fast(texts, **options)


def test_byte_bpe_asks_once_for_each_word():
    own = token_files.ByteBpe(BYTES)
    counted = {k: Counted(v) for k, v in vars(own).items() if hasattr(v, "encode_batch_fast")}
    vars(own).update(counted)
    words = [a + b for a in ("thon", "ere", "zü", "nd") for b in ("tion", "ly", "ñon", "st")]
    rng = np.random.default_rng(2)
    texts = ["".join(str(x) for w in rng.choice(words, 40) for x in (w, rng.choice([" ", ", ", ". ", ".\n", "\n"]))).strip() for _ in range(200)]
    got = own.encode(texts) + own.encode(texts)
    # With a blank and with a line end before it, and with what isn't cut off.
    assert sum(c.words for c in counted.values()) <= 4 * len(words)
    library = token_files.byte_bpe(BYTES).library
    assert [x.tolist() for x in got] == 2 * [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_byte_bpe_forgets_words_and_asks_again(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 20)
    own = token_files.ByteBpe(BYTES)
    for i in (0, 1, 2, 0, 1):
        texts = [f"{a}é {a}.\n{b},  {b}" * (b % 2) + f"{a}x {b}y." for a in range(i, i + 3) for b in range(9)]
        assert [x.tolist() for x in own.encode(texts)] == [e.ids for e in own.library.encode_batch(texts)]
        assert len(own.words) < 150


def test_byte_bpe_of_another_pattern_asks_for_whole_texts(tmp_path):
    from tokenizers import Tokenizer, pre_tokenizers

    library = Tokenizer.from_file(BYTES)
    library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True, use_regex=False)
    library.save(f"{tmp_path}/other.json")
    texts = ["", "the cat", "stop.\nThe cat, then.", " of  it\n"]
    own = token_files.ByteBpe(f"{tmp_path}/other.json")
    assert [x.tolist() for x in own.encode(texts)] == [e.ids for e in library.encode_batch(texts)]


def test_slices_of_texts_hold_all_rows(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_files, "SLICE_BYTES", 10)
    for texts in ([], [""], ["a" * 50], ["abcd"] * 9, ["", "a" * 30, "", "b", "c" * 9, "d" * 9]):
        rows = pa.array(texts, pa.string())
        cuts = list(token_files._slices(rows))
        assert [x for a, b in cuts for x in texts[a:b]] == texts
        assert all(sum(map(len, texts[a + 1 : b])) < 10 for a, b in cuts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 65_534), max_size=50), st.integers(1, 300))
def test_range_coder_round_trip(ids, times):
    ids = np.array(ids * times, np.int64)
    assert range_coder.decode(range_coder.encode(ids)).tolist() == ids.tolist()


def test_blocks_stand_alone_and_are_checked():
    ids = np.random.default_rng(1).integers(0, 300, 3 * range_coder.BLOCK + 5)
    blocks = range_coder.encode(ids)
    assert range_coder.decode(blocks[1:2]).tolist() == ids[range_coder.BLOCK : 2 * range_coder.BLOCK].tolist()
    assert sum(len(b[2]) for b in blocks) < 1.4 * len(ids)
    n, crc, code = blocks[0]
    with pytest.raises(ValueError, match="checksum"):
        range_coder.decode([(n, crc, code[:40] + bytes([code[40] ^ 1]) + code[41:])])


def test_token_files_give_back_ids_and_text(spark, tmp_path):
    token_files.write(frame(spark, ODD_ROWS), f"{tmp_path}/files", BYTES)
    rows = token_files.read(spark, f"{tmp_path}/files").orderBy("start").collect()
    library = token_files.byte_bpe(BYTES).library
    texts = sorted(((i is not None, i or 0, t or "") for i, t in ODD_ROWS))
    assert [library.decode(r["ids"][:-1], skip_special_tokens=False) for r in rows] == [t for _, _, t in texts]
    assert all(r["ids"][-1] == 2 for r in rows)


def test_directory_doubles_until_buckets_fit(spark):
    keys = spark.range(4000).selectExpr("xxhash64(id) as key")
    directory, bits = exact_dedup.build_directory(keys, 4000, 100)
    rows = directory.collect()
    assert len({r["slot"] for r in rows}) == len(rows) <= 1 << bits
    held = {}
    for k in keys.collect():
        slot = (k["key"] % (1 << 64)) >> (64 - bits)
        bucket = next(r["bucket"] for r in rows if r["slot"] == slot)
        held[bucket] = held.get(bucket, 0) + 1
    assert max(held.values()) <= 100 < 4000


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 300)] + [(1000 + i, 1000) for i in range(1, 50)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1050), 1000)}


def test_trigram_queries():
    query = {r.kind: secret_scan.trigram_query(r) for r in secret_scan.RULES}
    assert query["hex"] is None
    assert query["access"] == frozenset({frozenset({"aki", "kia"})})
    assert frozenset({"sec", "ecr", "cre", "ret"}) in query["assign"]
    loose = secret_scan.Rule("x", "(foo|ba)[0-9]+")
    assert secret_scan.trigram_query(loose) is None
    assert secret_scan.trigram_query(secret_scan.Rule("x", "(?:abcd)+z|hello\\d")) == frozenset(
        {frozenset({"abc", "bcd"}), frozenset({"hel", "ell", "llo"})}
    )


@settings(max_examples=200, deadline=None)
@given(st.sampled_from(secret_scan.RULES[:2] + secret_scan.EXTRA_RULES), st.data())
def test_matches_fulfil_their_query(rule, data):
    text = data.draw(st.from_regex(re.compile(rule.pattern, rule.flags | re.A)))
    query = secret_scan.trigram_query(rule)
    index = secret_scan.TrigramIndex([text], {g for s in query for g in s})
    assert index.candidates(query) == [0]


def test_extra_secrets_leave_base_columns(spark):
    docs = frame(spark, ODD_ROWS)
    columns = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert answers(secret_scan.scan(docs), *columns) == answers(secret_scan.scan(docs, extra=()), *columns)
    assert "github:0:40,hex:4:40" in [r["spans"] for r in secret_scan.scan(docs).collect()]


def test_pii_model_learns_reliabilities():
    right, wrong = (1, 1, 1, 0, 1, 1), (1, -1, 0, -1, -1, -1)
    rows = [(right, (2, 4, 5, 1, 1, 1, 1), 300), (wrong, (2, 4, 5, 0, 2, 2, 0), 500), ((1, 1, 0, 0, 1, 1), (2, 4, 5, 1, 1, 1, 0), 80)]
    model = pii.fit(rows)
    assert model.chance(rows[0][1]) > 0.9 > 0.1 > model.chance(rows[1][1])
    checksum = pii.LABELERS.index("checksum")
    assert model.reliability[checksum, 1, 2] > 0.9 > 0.1 > model.reliability[checksum, 0, 2]
    assert pii.fit([]).chance((0,) * 7) == pytest.approx(0.5, abs=0.2)


def test_proximity(spark):
    docs = frame(spark, [(1, "zebra " + "x " * 5 + "quagga"), (2, "zebra " + "x " * 50 + "quagga"), (3, "quagga zebra x x x"), (None, None)])
    bench = spark.createDataFrame([(1, "zebra x quagga"), (2, "x")], "item_id long, text string")
    got = decontaminate.proximity(docs, bench, slop=10)
    assert answers(got, "doc_id", "item_id", "pos_a", "pos_b") == [(1, "1", 6, 0), (3, "1", 0, 1)]


def test_no_items(spark):
    rows = decontaminate.contaminated(frame(spark, ODD_ROWS), items(spark).where("item_id = 3")).collect()
    assert len(rows) == len(ODD_ROWS) and not any(r["n_hit"] or r["n_items"] or r["contaminated"] for r in rows)
    assert ITEMS


def test_fm_pairs_in_linear_time():
    rng = np.random.default_rng(0)
    model = quality.FactorisationMachine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    index, value = np.array([3, 7, 20, 41]), rng.normal(size=4)
    pairs = sum(
        model.factors[a] @ model.factors[b] * x * y
        for k, (a, x) in enumerate(zip(index, value, strict=True))
        for b, y in list(zip(index, value, strict=True))[k + 1 :]
    )
    assert model.raw(index, value) == pytest.approx(0.3 + model.weights[index] @ value + pairs)


def test_fm_learns_a_pair():
    """Neither feature alone tells the label, only both together."""
    rows, labels = [], []
    for a in (0, 1):
        for b in (2, 3):
            rows += [(np.array([a, b]), np.ones(2, np.float32))] * 50
            labels += [int((a, b) in ((0, 2), (1, 3)))] * 50
    model = quality.fit(rows, labels, epochs=30)
    assert all((model.score(*r) > 0.5) == bool(y) for r, y in zip(rows, labels, strict=True))


@pytest.mark.parametrize("operator, column", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_accuracy(spark, operator, column):
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = operator.score(docs, operator.train(docs, marks))
    assert scored.count() == docs.count()
    rows = scored.join(marks, "doc_id").where("held_out").select("score", "predicted", column).collect()
    assert sum(r["predicted"] == r[column] for r in rows) > 0.95 * len(rows)
    ones, zeros = ([r["score"] for r in rows if r[column] == y] for y in (1, 0))
    # A toxic text without any word for it can't be told from others: ties count half.
    assert sum((a > b) + (a == b) / 2 for a in ones for b in zeros) > 0.93 * len(ones) * len(zeros)
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("operator, column", [(quality, "quality"), (toxicity, "toxic")])
def test_models_take_odd_rows(spark, operator, column):
    docs = frame(spark, ODD_ROWS)
    marks = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (5, 0), (5, 1), (77, 1)], f"doc_id long, {column} int")
    model = operator.train(docs, marks)
    rows = operator.score(docs, model).collect()
    assert len(rows) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert operator.score(docs.limit(0), model).collect() == []
    nothing = operator.train(docs.limit(0), marks.limit(0))
    assert len(operator.score(docs, nothing).collect()) == len(ODD_ROWS)


def test_grammar_scores_clauses():
    model = toxicity.Toxicity({"idiot$": 4.0, "vequ": 3.0}, (-3.0, 1.0, 2.0, 1.0))

    def total(text):
        return sum(s for _, _, s in model.clauses(text))

    assert total("you idiot") > total("an idiot") > total("not an idiot") > 0
    assert total("she said he is an idiot") < total("he is an idiot")
    assert total("they kill time") == 0 < total("you will die")
    assert total("vequanda") == 3.0 and total("idiotic") == 0
    assert [c[:2] for c in model.clauses("Fine. You idiot! Fine.")] == [(5, 15)]
    assert model.score("") == model.score("nothing here") < 0.7 < model.score("you idiot, you idiot")


def test_decisions_take_effect(spark):
    import corpus_pipeline

    docs = frame(spark, [*ODD_ROWS, (20, PASSAGE + " and more"), (21, " ".join(f"q{i}" for i in range(90)))])
    kept = corpus_pipeline.first_copies(spark, docs, None)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 4, 5, 7, 8, 9, 10, 11, 12, 13, 14, 15, -3, -4, 20, 21}
