"""The audit of filters against applying them one after the other, over files in any order."""

import itertools
import random
import re

import pytest

from tests.llm.test_contracts import ODD_ROWS, answers
from tidelog.llm import filter_audit

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
DOCS = "doc_id long, text string, lang string, source string, mask int, n long, part string"


def plain(rows, labels):
    """Every order applied to every document."""
    fails, last = [], 1 << 63
    for doc_id, text, lang in rows:
        t = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        place = last if doc_id is None else doc_id
        own = {"A"} if len(words) < 200 else set()
        own |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        own |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else set()
        own |= {"D"} if re.search("[#$%&*|]", t) else set()
        own |= {"E"} if any((u or "") == t and i is not None and i < place for i, u, _ in rows) else set()
        fails.append((lang or "", own, labels.get(doc_id, (0, 0))))
    out = []
    for part in {f[0] for f in fails}:
        here = [f for f in fails if f[0] == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        found = []
        for order in itertools.permutations("ABCDE"):
            left = here
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removed_by[f] += len(gone)
                redundant = sum(f in d[1] for d in here) - len(gone)
                lost = [sum(d[2][k] == 1 for d in gone) for k in (0, 1)]
                found.append((part, "".join(order), step, len(left), len(gone), redundant, sum(d[1] == {f} for d in here), *lost))
        out += [(*r, removed_by[r[1][r[2] - 1]]) for r in found]
    return sorted(out, key=repr)


def written(spark, path, files):
    """One Parquet file after the other, so that the stream takes them in this order."""
    for rows in files:
        made = [(i, t, lang, "s", 7, 9, "p") for i, t, lang in rows]
        spark.createDataFrame(made, DOCS).coalesce(1).write.mode("append").parquet(str(path))
    return str(path)


def marks(spark, labels):
    return spark.createDataFrame([(i, q, t) for i, (q, t) in labels.items()], "doc_id long, quality int, toxic int")


def random_files(seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choices(["a", "B", "c#", "dd", "e%", "word", "more"], k=rng.choice([0, 3, 30, 220]))) for _ in range(12)]
    texts += [" ".join(f"w{i}" for i in range(230)), None, ""]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice(["en", "de", "", None])) for _ in range(150)]
    rows += [(200 + k, texts[0], "en") for k in range(150, 0, -1)]
    labels = {i: (rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 300, 2)}
    return [rows[k::5] for k in range(5)], labels


@pytest.mark.parametrize("rounds, broadcast", [(5, 1000), (2, 0)])
def test_files_in_micro_batches(spark, tmp_path, rounds, broadcast):
    files, labels = random_files(rounds)
    path = written(spark, tmp_path / "docs", files)
    got = filter_audit.audit(spark, path, marks(spark, labels), rounds=rounds, broadcast_labels=broadcast, folder=str(tmp_path / "run"), bucket_texts=rounds * 9)
    assert answers(got, *COLUMNS) == plain(sum(files, []), labels)
    assert len([*(tmp_path / "run" / "counters").iterdir()]) > rounds


def test_smaller_ids_take_back(spark, tmp_path):
    """The id falls from file to file: each time an earlier row becomes a repetition."""
    files = [[(9 - k, "some text", "en" if k % 2 else "de")] for k in range(4)]
    path = written(spark, tmp_path / "docs", files)
    folder = tmp_path / "run"
    counted = filter_audit.counters(spark, path, marks(spark, {9: (1, 1)}), rounds=4, folder=str(folder))
    assert answers(counted, "part", "mask", "n", "n_good", "n_toxic") == [("de", 17, 2, 1, 1), ("en", 1, 1, 0, 0), ("en", 17, 1, 0, 0)]
    changes = spark.read.parquet(str(folder / "counters"))
    assert changes.where("n < 0").count() == 3


def test_a_run_goes_on_where_it_stopped(spark, tmp_path):
    files, labels = random_files(11)
    path, folder = tmp_path / "docs", str(tmp_path / "run")
    known = marks(spark, labels)
    written(spark, path, files[:2])
    first = filter_audit.audit(spark, str(path), known, rounds=2, folder=folder)
    assert answers(first, *COLUMNS) == plain(sum(files[:2], []), labels)
    written(spark, path, files[2:])
    again = filter_audit.audit(spark, str(path), known, rounds=2, folder=folder)
    assert answers(again, *COLUMNS) == plain(sum(files, []), labels)


def test_one_file_and_odd_rows(spark, tmp_path):
    rows = [(i, t, None if k % 3 else "en") for k, (i, t) in enumerate(ODD_ROWS)]
    path = written(spark, tmp_path / "docs", [rows])
    (file,) = (f for f in (tmp_path / "docs").iterdir() if f.suffix == ".parquet")
    for place in (path, str(file)):
        assert answers(filter_audit.audit(spark, place, marks(spark, {5: (1, 0)})), *COLUMNS) == plain(rows, {5: (1, 0)})


def test_repeated_and_missing_labels(spark, tmp_path):
    path = written(spark, tmp_path / "docs", [[(1, "x", "en"), (1, "y", "en"), (None, "z", "en")]])
    rows = [(1, 0, 1), (1, 1, None), (None, 1, 1), (2, None, None)]
    got = filter_audit.audit(spark, path, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    assert answers(got, *COLUMNS) == plain([(1, "x", "en"), (1, "y", "en"), (None, "z", "en")], {1: (1, 1)})


def test_empty_table(spark, tmp_path):
    path = written(spark, tmp_path / "docs", [[]])
    assert filter_audit.audit(spark, path, marks(spark, {})).collect() == []
