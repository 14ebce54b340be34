"""Training samples stay within their bound where a labelled id is repeated."""

import pytest

from tests.llm.test_contracts import frame
from tidelog.llm import quality, toxicity


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_one_row_of_a_repeated_id(spark, monkeypatch, operator):
    seen, mapped = [], operator.map_batches

    def counted(rows, step, schema):
        seen.append(rows.count())
        return mapped(rows, step, schema)

    monkeypatch.setattr(operator, "map_batches", counted)
    marks = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 13)], "doc_id long, quality int, toxic int")
    rows = [(i, f"some text number {i} of a table") for i in range(1, 13)]
    sampled = len(rows)
    rows += [(i, f"another text {k} of id {i}") for i in range(1, 13) for k in range(30)]
    operator.train(frame(spark, rows), marks)
    assert seen and max(seen) <= sampled
