"""What a plan sends through the driver: never rows that an explode has multiplied, however small the table is."""

from pyspark.sql import functions as F

from tests.llm.test_contracts import answers
from tidelog.llm import filter_audit, simhash


def broadcast_sides(df):
    """The plan of each side that a join of ``df`` builds for all tasks."""
    found, pending = [], [df._jdf.queryExecution().sparkPlan()]
    while pending:
        node = pending.pop()
        if node.nodeName().startswith("Broadcast"):
            found.append((node.left() if node.buildSide().toString() == "BuildLeft" else node.right()).treeString())
        children = node.children()
        pending += [children.apply(i) for i in range(children.size())]
    return found


def test_labels_beyond_the_bound_are_not_broadcast(spark):
    rows = spark.createDataFrame([(i % 7 if i else filter_audit._LAST_ID, "en", bytes([i]), 0) for i in range(40)], "doc_id long, part string, key binary, mask int")
    labels = spark.createDataFrame([(i, i % 2, int(i == 4)) for i in range(5)], "doc_id long, quality int, toxic int")
    shuffled = filter_audit.labelled(rows, labels, 0)
    assert broadcast_sides(shuffled) == []
    few = filter_audit.labelled(rows, labels, 1000)
    assert len(broadcast_sides(few)) == 1
    assert answers(shuffled, "key", "good", "toxic") == answers(few, "key", "good", "toxic")
    assert shuffled.where("good").count() == 12 and shuffled.where(F.col("doc_id") == filter_audit._LAST_ID).count() == 1


def test_balls_of_fingerprints_are_not_broadcast(spark):
    fps = [*range(40), 1 << 40, (1 << 40) + 1, (1 << 40) + 14, -1, -(1 << 62) - 1]
    table = spark.createDataFrame([(f,) for f in fps], "fp long")
    close = {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    for bucket in (1, 1000):
        links = simhash.near_links(table, bucket)
        assert [side for side in broadcast_sides(links) if "Generate" in side] == []
        # Of full buckets only links to the smallest fingerprint around are made.
        assert {*answers(links, "a", "b")} == close if bucket == 1000 else {*answers(links, "a", "b")} <= close
