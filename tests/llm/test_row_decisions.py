"""The pipeline's filtering stages decide row by row, also where ids are null or repeated."""

import pytest

import corpus_pipeline
from tests.llm.test_contracts import frame
from tidelog.llm import quality
from tidelog.llm.common import ROW

SF = "/root/testdata/sf0.001"
LEAK = "some words before and then the whole of {} and a few words after it"
CLEAN = " ".join(f"q{i}" for i in range(40))


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("id_", [None, 7])
def test_contaminated_rows_go(spark, id_):
    item = next(r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(r["text"].split()) > 12)
    docs = frame(spark, [(id_, CLEAN), (id_, LEAK.format(item)), (1, CLEAN)])
    assert texts(corpus_pipeline.clean_documents(spark, docs, SF)) == sorted([(id_, CLEAN), (1, CLEAN)], key=repr)


@pytest.mark.parametrize("stage", [corpus_pipeline.first_copies, corpus_pipeline.distinct_documents])
def test_one_row_of_a_group_stays(spark, stage):
    other = CLEAN.replace("q", "r")
    rows = [(None, CLEAN), (None, CLEAN), (3, CLEAN), (3, CLEAN), (3, other), (None, other), (None, CLEAN.replace("q", "s")), (None, CLEAN.replace("q", "s"))]
    assert texts(stage(spark, frame(spark, rows), None)) == sorted([(3, CLEAN), (3, other), (None, CLEAN.replace("q", "s"))], key=repr)


@pytest.mark.parametrize("id_", [None, 7])
def test_rejected_rows_go(spark, monkeypatch, id_):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    monkeypatch.setattr(quality, "train", lambda *_: model)
    good = {r["doc_id"] for r in quality.score(docs, model).where("predicted = 1").collect()}
    rows = docs.collect()
    kept = corpus_pipeline.good_documents(spark, spark.createDataFrame([{**r.asDict(), "doc_id": id_} for r in rows], docs.schema), SF)
    assert 0 < len(good) < len(rows)
    assert texts(kept) == sorted(((id_, r["text"]) for r in rows if r["doc_id"] in good), key=repr)


def test_a_column_of_the_name_of_the_row_key_stays(spark):
    docs = frame(spark, [(3, CLEAN), (2, CLEAN), (4, None), (5, "")]).withColumnRenamed("lang", ROW)
    kept = corpus_pipeline.first_copies(spark, docs, None)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.select("doc_id", ROW).collect())) == [(2, "en"), (4, "en")]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_empty_table(spark, name, stage):
    docs = frame(spark, [])
    got = stage(spark, docs, SF)
    assert got.collect() == [] and (name == "bpe" or got.columns == docs.columns)
