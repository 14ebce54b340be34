import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from tidelog.functions.cursors import empty_as_null, offset_value, read_cursor
from tidelog.functions.events import checked_data_op_name, metadata_to_publish, new_metadata
from tidelog.model import business_event, data_change_event
from tidelog.operators import envelope as env

from helpers import rows

# Lines as our own log gives them: clicks and purchases of the ``events`` table.
CURSOR = {"partition": "3", "offset": "1207", "event_type": "purchase", "cursor_token": "token-1207"}


def purchase(event_id: int, user_id: int, value: float, at: str) -> dict:
    return {
        "metadata": {"eid": f"e{event_id}", "event_type": "purchase", "partition": str(user_id % 8), "occurred_at": at},
        "data_type": "purchase",
        "data_op": "S" if event_id % 2 else "U",
        "data": {"user_id": user_id, "value": value, "props": {"k": event_id % 100}},
    }


EVENTS = [
    purchase(4410, 883, 12.25, "2024-01-07T23:30:00-03:30"),
    purchase(4411, 811, 0.5, "2024-01-08T03:00:01Z"),
    purchase(4412, 3, 199.99, "2024-01-08T05:00:02.250+02:00"),
]
INFO = {"frames": 12, "late": [True, None]}
PAYLOAD = T.StructType([T.StructField("count", T.LongType())])


def line(spark, *values):
    return env.parse_lines(spark.createDataFrame([(v,) for v in values], "value string"))


@pytest.mark.parametrize("info", [None, INFO])
@pytest.mark.parametrize("events", [None, EVENTS[:1], EVENTS])
def test_batch_lines(spark, info, events):
    parts = {"cursor": CURSOR} | ({"events": events} if events else {}) | ({"info": info} if info else {})
    got = line(spark, json.dumps(parts)).first()
    assert (got["partition"], got["offset"], got["event_type"], got["cursor_token"]) == tuple(
        CURSOR[k] for k in ("partition", "offset", "event_type", "cursor_token")
    )
    assert got["problem"] is None
    assert got["kind"] == ("batch" if events else "keep_alive")
    assert got["has_info"] == (info is not None)
    assert got["info"] == (json.dumps(info) if info else None)
    assert got["n_events"] == len(events or [])


@pytest.mark.parametrize(
    "array, n",
    [
        ("[]", 0),
        ("[\\n\\t ]".encode().decode("unicode_escape"), 0),
        ("[[[]]]", 1),
        ('[{"k":{"k":[1,{"k":"],["}]}}]', 1),
        ('["\\\\", "\\"], ["]', 2),
        ('[null,{"value":1.50},"}{"]', 3),
        ('[ 0 ,[1 , 2], true,"\\u005d" ,{} ]', 5),
    ],
)
def test_array_counts(spark, array, n):
    got = line(spark, '{"cursor":%s,"events":%s}' % (json.dumps(CURSOR), array)).first()
    assert (got["n_events"], got["kind"]) == (n, "batch")


def test_bad_lines(spark):
    lacks = {k: v for k, v in CURSOR.items() if k != "offset"}
    bad = [
        '{"cursor":{"part',
        "{}",
        json.dumps({"cursor": lacks, "events": []}),
        json.dumps({"cursor": CURSOR | {"partition": ""}}),
    ]
    parsed = line(spark, *bad, json.dumps({"cursor": CURSOR}))
    problems = [r["problem"] for r in parsed.collect()]
    assert problems == ["not a JSON line", "no cursor", "no cursor offset", "no cursor partition", None]
    assert env.valid_lines(parsed).count() == 1
    assert env.quarantined_lines(parsed).count() == 4
    with pytest.raises(Exception, match="bad batch line"):
        env.valid_lines(parsed, "fail").collect()


def test_data_change_events_in_utc(spark):
    lines = env.valid_lines(line(spark, json.dumps({"cursor": CURSOR, "events": EVENTS})))
    data = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])
    decoded = env.decode_events(env.explode_events(env.event_batches(lines)), data_change_event(data), ["data.value"])
    got = [
        (r["meta_eid"], r["user_id"], r["value"], r["data_op_name"], r["meta_occurred_at"])
        for r in env.flatten_data_change(decoded).orderBy("meta_eid").collect()
    ]
    assert got == [
        ("e4410", 883, 12.25, "update", datetime(2024, 1, 8, 3)),
        ("e4411", 811, 0.5, "snapshot", datetime(2024, 1, 8, 3, 0, 1)),
        ("e4412", 3, 199.99, "update", datetime(2024, 1, 8, 3, 0, 2, 250_000)),
    ]


def test_decode_each_event_on_its_own(spark):
    events = [{"count": 1}, {"count": "many"}, {}, {"count": None}, 7]
    lines = env.valid_lines(line(spark, json.dumps({"cursor": CURSOR, "events": events})))
    decoded = env.decode_events(env.explode_events(lines), business_event(PAYLOAD), ["count"])
    got = [(r["pos"], r["error"], r["event"]) for r in decoded.orderBy("pos").collect()]
    assert [g[1] for g in got] == [
        None,
        "count: string instead of bigint",
        "missing count",
        "missing count",
        "event: bigint instead of struct",
    ]
    assert got[1][2] == '{"count": "many"}'
    totals = env.decode_failures(decoded, ["event_type"]).first()
    assert (totals["n_failed"], totals["n_events"]) == (4, 5)


def test_bytes_and_assembly(spark):
    text = json.dumps({"cursor": CURSOR, "events": [{"count": 1}, {"count": 22}]}, separators=(",", ":"))
    got = env.byte_stats(line(spark, text, json.dumps({"cursor": CURSOR}), json.dumps({"cursor": CURSOR, "events": []}))).collect()
    assert got[0]["n_bytes"] == len(text)
    assert [g["n_events_bytes"] for g in got] == [len('[{"count":1},{"count":22}]'), 0, 2]
    events = spark.createDataFrame([("b", 2, "{2}"), ("b", 1, "{1}"), ("e", 1, "")], "batch string, pos int, event string")
    bodies = {r["batch"]: r["body"] for r in env.assemble_events(events, ["batch"], "pos").collect()}
    assert bodies == {"b": "[{1},{2}]", "e": ""}


def test_cursor_forms(spark):
    df = spark.createDataFrame(
        [
            ('{"event_type":"e","partition":"0","offset":"begin"}',),
            ('{"event_type":"e","cursor":{"partition":"1","offset":"17"}}',),
        ],
        "j string",
    ).select(read_cursor(F.col("j")).alias("c"))
    assert rows(df.select("c.event_type", "c.partition", offset_value(F.col("c.offset")))) == [("e", "0", -1), ("e", "1", 17)]
    assert spark.sql("select '' as s").select(empty_as_null(F.col("s"))).first()[0] is None


def test_metadata(spark):
    df = spark.sql(
        "select named_struct('eid','e','event_type','t','occurred_at',timestamp'2024-01-01','received_at',"
        "timestamp'2024-01-02','parent_eids',cast(null as array<string>),'partition','3','version','1','flow_id','f') as m"
    )
    got = df.select(metadata_to_publish(F.col("m")).alias("p")).first()["p"]
    assert (got["eid"], got["partition"], got["parent_eids"], got["flow_id"]) == ("e", None, [], "f")
    assert "received_at" not in got.asDict()
    fresh = spark.range(3).select(new_metadata().alias("m"))
    assert fresh.select("m.eid").distinct().count() == 3
    with pytest.raises(Exception, match="unknown data_op"):
        spark.sql("select 'X' as op").select(checked_data_op_name(F.col("op"))).collect()


def test_texts_as_received(spark):
    events = [' {"value": 1.50,"n":12345678901234567890.12345 }', '"]"', "[ 1,\t2 ]", '{"é": "\\u00e9"}']
    text = '{ "info" : {"a": [1 , {}]}, "events":[%s ] ,"cursor":%s}' % (" ,".join(events), json.dumps(CURSOR))
    parsed = env.parse_lines(spark.createDataFrame([(text,), (json.dumps({"cursor": CURSOR}),), ("{",), (None,)], "value string"))
    got = parsed.collect()
    assert got[0]["events"] == [e.strip() for e in events] and got[0]["info"] == '{"a": [1 , {}]}'
    assert [g["kind"] for g in got] == ["batch", "keep_alive", "bad", "bad"]
    sizes = [r["n_events_bytes"] for r in env.byte_stats(parsed).collect()]
    assert sizes == [len(f"[{' ,'.join(events)} ]".encode()), 0, 0, 0]
    number = T.StructType([T.StructField("n", T.DecimalType(30, 5)), T.StructField("value", T.StringType())])
    decoded = env.decode_events(env.explode_events(env.valid_lines(parsed)), number).orderBy("pos").first()
    assert str(decoded["decoded"]["n"]) == "12345678901234567890.12345"


def test_offsets_that_are_no_numbers(spark):
    opaque = json.dumps({"cursor": CURSOR | {"offset": "001-0001-000000000000001207"}, "events": []})
    frames = spark.createDataFrame([(opaque,)], "value string")
    assert [r["problem"] for r in env.quarantined_lines(env.parse_lines(frames, numeric_offsets=True)).collect()] == ["cursor offset is no number"]
    kept = env.valid_lines(env.parse_lines(frames)).first()
    assert (kept["offset"], kept["offset_text"]) == (None, "001-0001-000000000000001207")


DEEP = "[" * 150 + "]" * 150


@pytest.mark.parametrize(
    "events",
    [
        ['{"value":1.50}', '{"value":1234567890123456789012345.5}'],
        ['"a\\\\"', '"]\\", {"', "null", "true", "-1.0E+2", "[ ]", "{}"],
        ['{"events":[{"k":"\\u0041"}],"info":{"a":1}}', DEEP, '{"a":"' + "\\n" * 20_000 + '"}'],
        [],
    ],
)
@pytest.mark.parametrize("blank", ["", " \t"])
@pytest.mark.parametrize("info", ['{"a":1.0}', '{"events":[1]}', '"text"', "7", "null", None])
def test_parts_are_as_received(spark, events, blank, info):
    b = blank
    array = f"[{b}{f'{b},{b}'.join(events)}{b}]"
    text = f'{b}{{{b}"cursor"{b}:{json.dumps(CURSOR)},{b}"events"{b}:{b}{array}{b}' + (f',{b}"info":{b}{info}{b}' if info else "") + "}"
    got = env.byte_stats(line(spark, text)).first()
    assert got["problem"] is None and got["events"] == events and got["n_events"] == len(events)
    assert got["n_events_bytes"] == len(array.encode()) and got["n_bytes"] == len(text.encode())
    assert got["info"] == (None if info == "null" else info)


def test_odd_keys_and_depth(spark):
    cursor = json.dumps(CURSOR)
    odd = '{"cursor":%s,"ev\\u0065nts":[1.50],"events_":[2],"x":{"events":[3]}}' % cursor
    twice = '{"events":[1],"cursor":%s,"events":[ 2.0]}' % cursor
    deep = '{"cursor":%s,"events":[%s]}' % (cursor, "[ " * 300 + "]" * 300)
    got = line(spark, odd, twice, deep).collect()
    assert [g["events"] for g in got[:2]] == [["1.50"], ["2.0"]]
    assert got[2]["problem"] == "nested deeper than 200"


def test_reasons(spark):
    fields = "a struct<b: int, t: timestamp>, n decimal(30,5), l array<int>, f boolean, s string"
    schema = spark.createDataFrame([], fields).schema
    texts = {
        '{"a":{"b":1.5}}': "a.b: decimal instead of int",
        '{"a":[1]}': "a: array instead of struct",
        '{"a":{"t":"2024-01-01T00:00:00Z"},"n":"x"}': "n: string instead of decimal",
        '{"a":{"t":"soon"}}': "a.t: no timestamp",
        '{"l":{"k":1},"s":{"any":1}}': "l: object instead of array",
        '{"f":"yes"}': "f: string instead of boolean",
        "{": "not JSON",
        "null": "event: void instead of struct",
        '{"n":1234567890123456789012345.50}': None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "event string")
    got = {r["event"]: r["error"] for r in env.decode_events(df, schema).collect()}
    assert got | {"null": texts["null"]} == texts
    assert got["null"] is not None
