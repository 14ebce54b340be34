import pytest
from pyspark.sql import functions as F

from tidelog.functions.hashing import compound_key, key_hash, partition_of_hash, unsigned_mod, unsigned_text
from tidelog.operators.partitioning import (
    assign_by_strategy,
    assign_partitions,
    partition_count,
    partition_for_key,
    partition_list,
)

from helpers import rows

# Keys with their hash; key i goes to partition i of twelve.
GOLDEN = [
    ("HE742A011-Q110010000", 8382545129338073832),
    ("PU143E0A9-Q110152000", 2242809023958206461),
    ("EV421T048-Q11000L000", 14780139298840732394),
    ("M5921E05S-Q1100XL000", 14777921106714327039),
    ("INL81R01D-A11000S000", 13851497914756523380),
    ("AD121G084-G110034000", 14774336303094658421),
    ("AD541D1FZ-J11000S000", 14545158386393691066),
    ("MQ581A002-Q11000S000", 13866904338030752491),
    ("ZZO0UCT55-G00046FB4A", 16561860853217772572),
    ("ORJ21C05M-K110040000", 14797538103842336865),
    ("ZZO0TXN53-N00046AAAF", 10014478766256073642),
    ("AD581A007-A11000S000", 13863609120258880235),
]


def plain_hash(key: str) -> int:
    body = key.encode()
    crc = (1 << 64) - 1
    for byte in len(body).to_bytes(8, "little") + body:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ (0xD800000000000000 if crc & 1 else 0)
    return crc ^ (1 << 64) - 1


def test_golden_hashes_and_partitions(spark):
    df = spark.createDataFrame([(k,) for k, _ in GOLDEN], "k string")
    ids = spark.createDataFrame([(str(i),) for i in range(12)], "partition string")
    listed = partition_list(ids)
    assert listed == [str(i) for i in range(12)]
    got = df.select("k", unsigned_text(key_hash(F.col("k"))), partition_for_key(F.col("k"), listed)).collect()
    assert {r[0]: int(r[1]) for r in got} == dict(GOLDEN)
    assert {r[0]: r[2] for r in got} == {k: str(i) for i, (k, _) in enumerate(GOLDEN)}


@pytest.mark.parametrize("key", ["", "a", "é€ß", "日本語", "x" * 255, "x" * 256, "y" * 300, "\x00\x7f"])
def test_hash_of_any_length(spark, key):
    df = spark.createDataFrame([(key,), (None,)], "k string")
    got = [r[0] for r in df.select(unsigned_text(key_hash(F.col("k")))).collect()]
    assert got == [str(plain_hash(key)), None]


def test_modulo_table(spark):
    df = spark.createDataFrame([(i,) for i in range(6)], "h long")
    got = [r[0] for r in df.orderBy("h").select(partition_of_hash(F.col("h"), ["1", "2", "3"])).collect()]
    assert got == ["1", "2", "3", "1", "2", "3"]
    signed = spark.createDataFrame([(-1,)], "h long").select(unsigned_mod(F.col("h"), F.lit(7).cast("long"))).first()[0]
    assert signed == (2**64 - 1) % 7


def test_partition_order(spark):
    def order(*ids):
        return partition_list(spark.createDataFrame([(i,) for i in ids], "partition string"))

    assert order("10", "9", "2") == ["2", "9", "10"]
    assert order("10", "9", "b") == ["10", "9", "b"]
    # Beyond 64 bits it is not a number.
    assert order("18446744073709551616", "3") == ["18446744073709551616", "3"]


def test_compound_keys_do_not_collide(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("", "abc"), (None, "abc"), ("1:a", "b")], "x string, y string")
    assert df.select(compound_key(F.col("x"), F.col("y"))).distinct().count() == 5


def test_strategies(spark):
    df = spark.createDataFrame([("e1", "0"), ("e2", "7"), ("e3", None)], "eid string, partition string")
    got = rows(assign_by_strategy(df, "user_defined", ["0", "1"]), "eid", "assigned", "rejection")
    assert got == [("e1", "0", None), ("e2", None, "unknown partition 7"), ("e3", None, "no partition given")]
    random = assign_by_strategy(df, "random", ["0", "1", "2"])
    assert rows(random) == rows(random)
    nested = spark.sql("select named_struct('id', 'k1') as data, 'e' as eid")
    got = assign_by_strategy(nested, "hash", ["0", "1"], key_fields=["id"], category="data").first()["assigned"]
    assert got == str(plain_hash("k1") % 2)
    with pytest.raises(ValueError):
        assign_by_strategy(df, "hash", ["0"])
    with pytest.raises(ValueError):
        partition_for_key(F.col("eid"), [])


def test_assign_with_own_hasher_and_extractor(spark):
    df = spark.sql("select 5L as n, named_struct('partition', cast(null as string)) as metadata")
    out = assign_partitions(df, lambda d: d["n"], ["a", "b", "c"], hasher=lambda k: k)
    assert out.first()["metadata"]["partition"] == "c"


def test_partition_count(spark):
    assert spark.range(1).select(partition_count(F.lit(3), F.lit(8))).first()[0] == 8
