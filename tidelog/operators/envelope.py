"""Batch lines: parse, classify, validate, explode, decode, assemble.

A line is parsed once, into the cursor, the events as an array of JSON texts and the
info text, all as they were received. Spark's JSON functions re-render nested values
(whitespace goes, ``1.50`` becomes ``1.5``, long numbers become doubles), so a rendered
text is taken only if the line holds it letter by letter; from any other line the parts
are cut out with patterns of balanced brackets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidelog.functions.cursors import offset_value
from tidelog.functions.events import data_op_name
from tidelog.model import METADATA

CURSOR_FIELDS = ("partition", "offset", "event_type", "cursor_token")

_LINE = (
    "cursor struct<partition: string, offset: string, event_type: string, cursor_token: string>,"
    " events array<string>, info string, _broken string"
)


def _once(parsed: Column, *names: str) -> Column:
    """The fields of a parsed struct as columns, parsed once per row.

    A filter on a parsed field would otherwise be pushed below the projection and parse
    the text again; it is not pushed through a generator.
    """
    return F.inline(F.array(parsed)).alias(*names)


# Brackets nested deeper than this make a line a bad one.
MAX_DEPTH = 200
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_BLANKS = r"[ \t\n\r]*+"


def _value_pattern(depth: int) -> str:
    """One JSON value of a valid text. All loops are possessive, so matching takes linear time and no deep stack."""
    inside = rf'[^{{}}\[\]"]++|{_STRING}'
    balanced = inside
    for _ in range(depth):
        balanced = rf"{inside}|[{{\[](?:{balanced})*+[}}\]]"
    return rf'[{{\[](?:{balanced})*+[}}\]]|{_STRING}|[^\s,:{{}}\[\]"]++'


_VALUE = _value_pattern(MAX_DEPTH)
_MEMBER = rf"({_STRING}){_BLANKS}:{_BLANKS}({_VALUE})"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), 0)


def _received_parts(text: Column) -> Column:
    """events, info and the size in bytes of the events array, cut out of a line as they stand there.

    ``deep`` tells that brackets are nested deeper than MAX_DEPTH, so that the patterns leave something over.
    """
    body = F.regexp_replace(text, rf"^{_BLANKS}\{{", "")
    members = F.struct(
        F.arrays_zip(
            F.regexp_extract_all(body, F.lit(_MEMBER), F.lit(1)).alias("key"),
            F.regexp_extract_all(body, F.lit(_MEMBER), F.lit(2)).alias("text"),
        ).alias("all"),
        F.regexp_replace(body, _MEMBER, "").alias("rest"),
    )

    def last(found: Column, name: str) -> Column:
        key = lambda m: F.get_json_object(F.concat(F.lit('{"k":'), m["key"], F.lit("}")), "$.k") == name
        return F.try_element_at(F.filter(found["all"], key), F.lit(-1))["text"]

    def parts(found: Column) -> Column:
        inner = F.regexp_replace(last(found, "events"), r"^\[", "")
        deep = ~found["rest"].rlike(r"^[ ,\t\n\r]*\}[ \t\n\r]*$") | ~F.coalesce(
            F.regexp_replace(inner, _VALUE, "").rlike(r"^[ ,\t\n\r]*\]$"), F.lit(True)
        )
        return F.struct(
            F.regexp_extract_all(inner, F.lit(_VALUE), F.lit(0)).alias("events"),
            last(found, "info").alias("info"),
            F.octet_length(last(found, "events")).alias("events_bytes"),
            deep.alias("deep"),
        )

    return _let(members, parts)


def _exact_parts(text: Column, events: Column, info: Column) -> Column:
    """The parts as received. What was rendered is exact if it stands in the line, under the only such key."""

    def stands(name: str, rendered: Column) -> Column:
        once = F.length(text) - F.length(F.replace(text, F.lit(f'"{name}"'), F.lit(""))) == len(name) + 2
        return rendered.isNull() | (once & F.contains(text, F.concat(F.lit(f'"{name}":'), rendered)))

    array = F.concat(F.lit("["), F.array_join(events, ",", "null"), F.lit("]"))
    same = stands("events", array) & stands("info", info) & ~F.exists(F.coalesce(events, F.array().cast("array<string>")), F.isnull)
    # A string is given without its quotes, so it doesn't stand as rendered.
    whole = F.forall(F.coalesce(events, F.array().cast("array<string>")), lambda e: e.rlike(r"^[\[{\d-]")) & (
        F.coalesce(info, F.lit("{")).rlike(r"^[\[{]")
    )
    rendered = F.struct(
        events.alias("events"), info.alias("info"), F.octet_length(array).alias("events_bytes"), F.lit(False).alias("deep")
    )
    return F.when(F.coalesce(same & whole, F.lit(False)), rendered).otherwise(_received_parts(text))


def parse_lines(frames: DataFrame, value: str = "value", *, numeric_offsets: bool = False) -> DataFrame:
    """Add cursor fields, ``events`` (JSON texts, NULL for a keep-alive), ``info``, ``events_bytes``,
    ``n_events``, ``kind``, ``has_info`` and ``problem`` (NULL for a valid line).

    Texts are as received. So is the offset, which may be any text; with ``numeric_offsets`` one that is no number
    is a problem of its line.
    """
    line = F.from_json(value, _LINE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    parsed = frames.select("*", _once(line, "_cursor", "_events", "_info", "_broken"))
    broken = F.col(value).isNull() | F.col("_broken").isNotNull()
    parts = F.when(~broken, _exact_parts(F.col(value), F.col("_events"), F.col("_info")))
    parsed = parsed.select("*", _once(parts, "_raw_events", "_raw_info", "_bytes", "_deep"))
    cursor = F.col("_cursor")
    events = F.when(F.col("_events").isNotNull(), F.col("_raw_events"))
    info = F.when(F.col("_info").isNotNull(), F.col("_raw_info"))
    empty = F.array_compact(
        F.array(*[F.when(F.coalesce(cursor[f], F.lit("")) == "", F.lit(f)) for f in CURSOR_FIELDS])
    )
    problem = (
        F.when(broken, F.lit("not a JSON line"))
        .when(F.col("_deep"), F.lit(f"nested deeper than {MAX_DEPTH}"))
        .when(cursor.isNull(), F.lit("no cursor"))
        .when(F.size(empty) > 0, F.concat(F.lit("no cursor "), F.array_join(empty, ",")))
    )
    if numeric_offsets:
        problem = problem.when(offset_value(cursor["offset"]).isNull(), F.lit("cursor offset is no number"))
    kind = (
        F.when(problem.isNotNull(), F.lit("bad"))
        .when(events.isNull(), F.lit("keep_alive"))
        .otherwise(F.lit("batch"))
    )
    return parsed.select(
        *frames.columns,
        *[cursor[f].alias(f) for f in ("event_type", "partition", "offset", "cursor_token")],
        events.alias("events"),
        info.alias("info"),
        F.when(F.col("_events").isNotNull(), F.col("_bytes")).alias("events_bytes"),
        F.coalesce(F.array_size(events), F.lit(0)).alias("n_events"),
        kind.alias("kind"),
        info.isNotNull().alias("has_info"),
        problem.alias("problem"),
    )


def valid_lines(parsed: DataFrame, mode: str = "quarantine") -> DataFrame:
    """Valid lines with the offset as a number, and as it was received in ``offset_text``.

    ``mode='fail'`` raises on a bad line.
    """
    if mode == "fail":
        reason = F.concat(F.lit("bad batch line: "), F.col("problem"))
        checked = F.when(F.col("problem").isNull(), F.lit(True)).otherwise(F.raise_error(reason).cast("boolean"))
        good = parsed.filter(checked)
    elif mode == "quarantine":
        good = parsed.filter(F.col("problem").isNull())
    else:
        raise ValueError(f"unknown mode: {mode}")
    return good.drop("problem").withColumns({"offset_text": F.col("offset"), "offset": offset_value(F.col("offset"))})


def quarantined_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNotNull())


def event_batches(lines: DataFrame) -> DataFrame:
    """Lines with an events array, possibly empty; keep-alives are dropped."""
    return lines.filter(F.col("events").isNotNull())


def byte_stats(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add n_bytes of the line and n_events_bytes of its events array, both as received."""
    return lines.withColumn("n_bytes", F.octet_length(value)).withColumn(
        "n_events_bytes", F.coalesce(F.col("events_bytes"), F.lit(0))
    )


def explode_events(batches: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per event in order, with its cursor and frame columns.

    ``pos`` is the event's place in its batch.
    """
    head = [c for c in ("stream_id", "frame_id", "event_type", "partition", "offset", "offset_text") if c in batches.columns]
    return batches.select(*head, *keep, F.posexplode("events").alias("pos", "event"))


def _required_missing(decoded: Column, schema: T.StructType, required: Sequence[str]) -> Column:
    """Names of required fields (dotted paths) that are NULL."""
    checks = []
    for path in required:
        field = decoded
        for name in path.split("."):
            field = field[name]
        checks.append(F.when(field.isNull(), F.lit(path)))
    if not checks:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*checks))


#: Kinds of JSON values that a type takes; any for strings.
_TAKES = {
    **dict.fromkeys(("tinyint", "smallint", "int", "bigint"), ("BIGINT",)),
    **dict.fromkeys(("float", "double", "decimal"), ("BIGINT", "DECIMAL", "DOUBLE")),
    **dict.fromkeys(("timestamp", "timestamp_ntz", "date"), ("STRING",)),
    **dict.fromkeys(("struct", "map"), ("OBJECT",)),
    "boolean": ("BOOLEAN",),
    "array": ("ARRAY",),
}


def _mismatch(event: Column, schema: T.StructType) -> Column:
    """Why a text doesn't match: the first field of another kind, with what it is and what is wanted."""
    value = F.try_parse_json(event)
    reasons = []

    def check(path: str, name: str, kind: T.DataType) -> None:
        simple = kind.simpleString().split("<")[0].split("(")[0]
        found = F.regexp_extract(F.schema_of_variant(F.try_variant_get(value, path, "variant")), "^[A-Z]+", 0)
        said = F.concat(F.lit(f"{name}: "), F.lower(found), F.lit(f" instead of {simple}"))
        if simple in _TAKES:
            reasons.append(F.when(~found.isin(*_TAKES[simple], "VOID"), said))
        if simple in ("timestamp", "timestamp_ntz", "date"):
            bad = (found == "STRING") & F.try_variant_get(value, path, simple).isNull()
            reasons.append(F.when(bad, F.lit(f"{name}: no {simple}")))
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                check(f"{path}['{f.name}']", f"{name}.{f.name}" if name != "event" else f.name, f.dataType)

    check("$", "event", schema)
    no_json = F.when(event.isNull(), F.lit("no event")).when(value.isNull(), F.lit("not JSON"))
    return F.coalesce(no_json, *reasons, F.lit("does not match the schema"))


def decode_events(
    rows: DataFrame, schema: T.StructType, required: Sequence[str] = (), event: str = "event"
) -> DataFrame:
    """Decode each event on its own into ``decoded``; ``error`` tells why it failed.

    The raw text stays in the row, so failures keep (raw value, error). PERMISSIVE
    parsing neither fails on missing fields nor tells which: ``required`` does. The
    reason for a failure is looked up in the text again, in failed rows only.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])
    parse = F.from_json(event, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    names = [f"_d_{f.name}" for f in schema.fields]
    parsed = rows.select("*", _once(parse, *names, "_broken"))
    decoded = F.struct(*[F.col(n).alias(f.name) for n, f in zip(names, schema.fields)])
    missing = _required_missing(decoded, schema, required)
    no_object = F.col(event).isNull() | F.col("_broken").isNotNull() | (F.btrim(event) == "null")
    error = F.when(no_object, _mismatch(F.col(event), schema)).when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ",")))
    return parsed.select(
        *rows.columns, error.alias("error"), F.when(error.isNull(), decoded).alias("decoded")
    )


def decode_failures(decoded: DataFrame, by: Sequence[str]) -> DataFrame:
    """Failed and all events per batch."""
    return decoded.groupBy(*by).agg(
        F.count_if(F.col("error").isNotNull()).alias("n_failed"), F.count(F.lit(1)).alias("n_events")
    )


def flatten_business(decoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Payload fields and ``meta_``-prefixed metadata fields as columns."""
    fields = [f.name for f in decoded.schema["decoded"].dataType.fields if f.name != "metadata"]
    return decoded.select(
        *keep,
        *[F.col(f"decoded.{n}").alias(n) for n in fields],
        *[F.col(f"decoded.metadata.{f.name}").alias(f"meta_{f.name}") for f in METADATA.fields],
    )


def flatten_data_change(decoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Data fields, data_type, data_op (with its name) and metadata as columns."""
    data = decoded.schema["decoded"].dataType["data"].dataType
    return decoded.select(
        *keep,
        *[F.col(f"decoded.data.{f.name}").alias(f.name) for f in data.fields],
        F.col("decoded.data_type").alias("data_type"),
        F.col("decoded.data_op").alias("data_op"),
        data_op_name(F.col("decoded.data_op")).alias("data_op_name"),
        *[F.col(f"decoded.metadata.{f.name}").alias(f"meta_{f.name}") for f in METADATA.fields],
    )


def json_array(texts: Column) -> Column:
    """JSON array text from an array of JSON texts in order; '' for an empty one."""
    all_empty = F.forall(texts, lambda t: t == "")
    return F.when(all_empty, F.lit("")).otherwise(F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")))


def assemble_events(rows: DataFrame, by: Sequence[str], order: str, event: str = "event") -> DataFrame:
    """The body of each publish batch: its events as one JSON array text, in order.

    A batch is what one publish call carries, so its size is the publisher's choice.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(event).alias("e"))))
    return rows.groupBy(*by).agg(
        json_array(F.transform(ordered, lambda r: r["e"])).alias("body"), F.count(event).alias("n_events")
    )


def _quoted(name: str, text: Column) -> Column:
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.when(text.isNotNull(), F.concat(F.lit(f'"{name}":"'), escaped, F.lit('"')))


def assemble_line(
    partition: Column, offset: Column, event_type: Column, token: Column, events: Column, info: Column
) -> Column:
    """A compact batch line from its parts; NULL parts are left out."""
    cursor = F.concat_ws(
        ",",
        _quoted("partition", partition),
        _quoted("offset", offset),
        _quoted("event_type", event_type),
        _quoted("cursor_token", token),
    )
    return F.concat(
        F.lit('{"cursor":{'),
        cursor,
        F.lit("}"),
        F.coalesce(F.concat(F.lit(',"events":['), F.array_join(events, ","), F.lit("]")), F.lit("")),
        F.coalesce(F.concat(F.lit(',"info":'), info), F.lit("")),
        F.lit("}"),
    )
