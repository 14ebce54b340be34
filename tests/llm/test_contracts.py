"""Every operator against its plain version, on hand-made rows and on the small tables."""

import random

import pytest

from tests.llm import brute
from tidelog.llm import bpe, decontaminate, exact_dedup, pii, secret_scan, simhash, suffix_dedup, token_files

WORDS = "/opt/tokenizers/word_bpe_49k.json"
BYTES = "/opt/tokenizers/byte_bpe_50k.json"
SF = "/root/testdata/sf0.001"

LONG = " ".join(f"w{i % 977} über{i % 13}" for i in range(12_000))
PASSAGE = "The quick brown fox jumps over the lazy dog while nobody in the yard is looking at it"
ODD_ROWS = [
    (1, PASSAGE),
    (2, None),
    (3, ""),
    (4, "  \t\n "),
    (None, PASSAGE),
    (None, None),
    (5, PASSAGE),
    (5, PASSAGE),
    (5, "another text under the same id"),
    (6, PASSAGE.replace(" ", "\n ")),
    (7, LONG),
    (8, LONG + " tail"),
    (9, "x"),
    (10, PASSAGE.upper() + " 日本語 ΑΣ Σ ǅ ﬁ 🎉\u0085 ​ é don't I'LL 3½"),
    (11, "aaaa " * 60 + "<|endoftext|>tail <|startoftext|> <|EndOfText|>"),
    (12, "x" * 300),
    (13, "token = abcdefgh1 PassWord:'p4ss/word=' api_key=short AKIA" + "Z" * 14 + " akia0000 " + "0a" * 20 + " SECRET: ſecret=12345678"),
    (14, "mail jo.x@a-b.example.com, @none a@b ip 1.2.3.4 300.1.1.1 card 4111 1111 1111 1111 phone +49 (30) 1234-567 and +1 23"),
    (-3, PASSAGE[:49]),
    (-4, "before " + PASSAGE[10:80] + " after"),
    (15, "ghp_" + "a1" * 18 + " call 030 1234 5678 or ssn 123-45-6789"),
]
ITEMS = [(1, PASSAGE), (2, "lazy dog while"), (None, "nobody in the yard"), (3, None), (4, "..."), (5, "w1 über1 w2")]


def frame(spark, rows, **extra):
    made = [(i, t, "en", "s", None if t is None else len(t), 0.5, True) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean"
    return spark.createDataFrame(made, schema)


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def answers(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


CASES = {
    "exact": (
        lambda spark, docs: exact_dedup.exact_duplicates(docs),
        brute.exact,
        ("doc_id", "keep_id", "group_size", "kept", "text_sha256"),
    ),
    "exact_colliding": (
        lambda spark, docs: exact_dedup.exact_duplicates(docs, bucket_entries=2, key_bits=2),
        brute.exact,
        ("doc_id", "keep_id", "group_size", "kept", "text_sha256"),
    ),
    "near": (lambda spark, docs: simhash.near_duplicates(docs), brute.near, ("doc_id", "fingerprint", "component_id")),
    "near_full_buckets": (
        lambda spark, docs: simhash.near_duplicates(docs, bucket=0),
        brute.near,
        ("doc_id", "fingerprint", "component_id"),
    ),
    "leaks": (
        lambda spark, docs: decontaminate.contaminated(docs, items(spark)),
        lambda rows: brute.leaks(rows, ITEMS),
        ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"),
    ),
    "leaks_in_blocks": (
        lambda spark, docs: decontaminate.contaminated(docs, items(spark), block_chars=200),
        lambda rows: brute.leaks(rows, ITEMS),
        ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"),
    ),
    "bpe": (
        lambda spark, docs: bpe.encode(docs, WORDS, keep_text=False),
        lambda rows: brute.bpe(rows, WORDS),
        ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"),
    ),
    "repeats": (
        lambda spark, docs: suffix_dedup.remove_repeats(docs),
        brute.repeats,
        ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"),
    ),
    "files": (
        lambda spark, docs: token_files.write_and_read(docs, BYTES),
        lambda rows: brute.token_files(rows, BYTES),
        ("doc_id", "start", "n_tokens", "ids_crc32"),
    ),
    "secrets": (
        lambda spark, docs: secret_scan.scan(docs),
        brute.secrets,
        ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256"),
    ),
    "pii": (
        lambda spark, docs: pii.find(docs),
        brute.pii,
        ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"),
    ),
}


@pytest.mark.parametrize("case", CASES)
def test_odd_rows(spark, case):
    run, plain, columns = CASES[case]
    assert answers(run(spark, frame(spark, ODD_ROWS)), *columns) == plain(ODD_ROWS)


@pytest.mark.parametrize("case", CASES)
def test_empty_table(spark, case):
    run, _, columns = CASES[case]
    assert answers(run(spark, frame(spark, [])), *columns) == []


@pytest.mark.parametrize("case", [c for c in CASES if c not in ("exact_colliding", "leaks_in_blocks")])
def test_small_table(spark, case):
    run, plain, columns = CASES[case]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert answers(run(spark, docs), *columns) == plain(rows)


def test_repeats_between_groups_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 3_000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_ANCHORS", 300)
    rng = random.Random(5)
    words = ["".join(rng.choices("abcde", k=rng.randint(1, 6))) for _ in range(300)]
    passages = [" ".join(rng.choices(words, k=14)) for _ in range(12)]
    rows = []
    for i in rng.sample(range(400), 150):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choices(words, k=9)) for _ in range(rng.randint(1, 8))]
        rows.append((i, " ".join(parts)))
    rows += [(500 + i, passages[0]) for i in range(60)] + [(600, "ab" * 400), (601, "ba" * 300), (602, "x" * 200), (603, "x" * 60)]
    got = suffix_dedup.remove_repeats(frame(spark, rows))
    assert answers(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeats(rows)


@pytest.mark.parametrize("size", [8, 23, 30])
def test_repeats_of_other_sizes(spark, size):
    rng = random.Random(size)
    rows = [(i, "".join(rng.choices("ab ", k=rng.randint(0, 60)))) for i in range(40)]
    got = suffix_dedup.remove_repeats(frame(spark, rows), min_bytes=size)
    assert answers(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeats(rows, size)


def test_near_links_of_random_clusters(spark):
    rng = random.Random(3)
    fps = set()
    for _ in range(30):
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 40)):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 3)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    from tidelog.llm.common import components

    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    wanted = {}
    for f in fps:
        wanted.setdefault(find(f), set()).add(f)
    for bucket in (0, 3, 1000):
        found = {}
        for r in components(simhash.near_links(signed, bucket)).collect():
            found.setdefault(r["root"], set()).add(r["node"] % (1 << 64))
        assert sorted(map(sorted, found.values())) == sorted(sorted(v) for v in wanted.values() if len(v) > 1)
