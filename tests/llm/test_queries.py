"""The registered queries: SQL twins on the small tables, and that all are there."""

import duckdb
import pytest

import __spark_entry__ as entry
from tidelog.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    got = sorted(map(tuple, QUERIES[name](spark, SF).select(*columns).collect()))
    assert got == sorted(found.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_pipeline(spark):
    """Every stage on what the one before kept, against the plain versions and the scores of the first."""
    import corpus_pipeline
    from tests.llm import brute
    from tidelog.llm import quality

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = quality.score(docs, quality.train(docs, marks)).where("predicted = 1").collect()
    left = [(r["doc_id"], rows[r["doc_id"]]) for r in good]
    kept = {r[0] for r in brute.exact(left) if r[3]}
    left = [r for r in left if r[0] in kept]
    kept = {r[0] for r in brute.near(left) if r[0] == r[2]}
    left = [r for r in left if r[0] in kept]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {r[0] for r in brute.leaks(left, items) if not r[5]}
    left = [r for r in left if r[0] in clean]
    assert 0 < len(left) < len(rows)
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect()), key=repr) == brute.bpe(left, "/opt/tokenizers/word_bpe_49k.json")
