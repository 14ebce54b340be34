"""The registered queries once more, as SQL for DuckDB over the same parquet tables."""

from __future__ import annotations

_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"


def _event_json(payload: str) -> str:
    metadata = f"""'"metadata":{{"eid":"' || eid || '","event_type":"' || event_type || '","occurred_at":"' || {_ISO}
      || '","received_at":"' || {_ISO} || '","parent_eids":[],"partition":"' || "partition"
      || '","version":"1.0.0","flow_id":"flow-' || CAST(event_id AS VARCHAR) || '"}}'"""
    return f"""CASE WHEN event_type IN ('purchase', 'signup')
      THEN '{{"data_type":"' || event_type || '","data_op":"' || substr('CUDS', CAST(event_id % 4 AS INTEGER) + 1, 1)
           || '","data":' || {payload} || ',' || {metadata} || '}}'
      ELSE left({payload}, length({payload}) - 1) || ',' || {metadata} || '}}' END"""


_AS_OF = "epoch_us(TIMESTAMP '2024-01-31 00:00:00')"

_TABLES = f"""
WITH RECURSIVE
ev AS (
  SELECT *, CAST(user_id % 8 AS VARCHAR) AS "partition", epoch_us(ts) AS us,
    '00000000-0000-4000-8000-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS eid,
    CAST(user_id AS VARCHAR) AS key,
    '{{"value":' || CAST(value AS VARCHAR) || ',"props":' || replace(props, ': ', ':') || '}}' AS payload,
    CAST(props->>'$.k' AS BIGINT) AS k
  FROM events),
log AS (
  SELECT *, row_number() OVER (PARTITION BY event_type, "partition" ORDER BY ts, event_id) - 1 AS "offset" FROM ev),
commits AS (
  SELECT 'stream-' || CAST(CAST("partition" AS INTEGER) % 4 AS VARCHAR) AS stream_id, event_type, "partition", "offset", us
  FROM log WHERE event_id % 10 = 0 AND event_type <> 'view'),
committed AS (SELECT event_type, "partition", max("offset") AS committed FROM commits GROUP BY ALL),
info AS (SELECT event_type, "partition", min("offset") AS oldest, max("offset") AS newest FROM log GROUP BY ALL),
stats AS (
  SELECT i.*, c.committed, i.newest - c.committed AS unconsumed,
    CASE WHEN CAST(i."partition" AS INTEGER) % 3 <> 2
         THEN 'stream-' || CAST(CAST(i."partition" AS INTEGER) % 4 AS VARCHAR) END AS stream_id
  FROM info i LEFT JOIN committed c USING (event_type, "partition")),
batches AS (
  SELECT event_type, "partition", "offset" // 10 AS batch_no, max("offset") AS "offset", max(us) AS seen_us, count(*) AS n
  FROM log GROUP BY ALL),
unnumbered AS (
  SELECT 'stream-' || CAST(CAST("partition" AS INTEGER) % 4 AS VARCHAR) AS stream_id, b.*, line_no, line_kind,
    seen_us + line_no * 1000000 AS started_us,
    CASE WHEN line_kind = 'batch' THEN n ELSE 0 END AS n_events
  FROM batches b CROSS JOIN (VALUES (0, 'batch'), (1, 'keep_alive'), (2, 'none')) k(line_no, line_kind)
  WHERE line_no = 0 OR (line_no = 1 AND batch_no % 10 = 9) OR (line_no = 2 AND batch_no % 20 = 19)),
lines AS (
  SELECT *, started_us + 2000 + n_events * 1000 AS completed_us,
    CASE WHEN line_kind = 'keep_alive' THEN 'keep_alive' ELSE 'batch' END AS kind,
    line_kind = 'batch' AND batch_no % 7 = 6 AS has_info,
    row_number() OVER (PARTITION BY stream_id ORDER BY started_us, event_type, "partition", batch_no, line_no) - 1 AS frame_id
  FROM unnumbered),
frame_batches AS (SELECT * FROM lines WHERE kind = 'batch'),
event_texts AS (SELECT *, "offset" // 10 AS batch_no, {_event_json("payload")} AS event FROM log),
array_texts AS (
  SELECT event_type, "partition", batch_no, string_agg(event, ',' ORDER BY "offset") AS texts FROM event_texts GROUP BY ALL),
line_bytes AS (
  SELECT l.*,
    octet_length(encode('{{"cursor":{{"partition":"' || "partition" || '","offset":"' || CAST("offset" AS VARCHAR)
      || '","event_type":"' || event_type || '","cursor_token":"token-' || CAST("offset" AS VARCHAR) || '"}}'
      || CASE line_kind WHEN 'batch' THEN ',"events":[' || texts || ']' WHEN 'none' THEN ',"events":[]' ELSE '' END
      || CASE WHEN has_info THEN ',"info":{{"debug":"batch ' || CAST(batch_no AS VARCHAR) || '"}}' ELSE '' END
      || '}}')) AS n_bytes,
    CASE line_kind WHEN 'batch' THEN octet_length(encode(texts)) + 2 WHEN 'none' THEN 2 ELSE 0 END AS n_events_bytes
  FROM lines l JOIN array_texts USING (event_type, "partition", batch_no)),
frame_events AS (
  SELECT l.stream_id, l.frame_id, g."offset" - l.batch_no * 10 AS pos, l.batch_no, l."offset" AS frame_offset, g.*
  FROM lines l JOIN log g ON l.line_kind = 'batch' AND g.event_type = l.event_type AND g."partition" = l."partition"
    AND g."offset" // 10 = l.batch_no),
corrupt_events AS (
  SELECT *, CASE WHEN event_id % 11 = 3
      THEN CASE WHEN event_type IN ('purchase', 'signup') THEN 'data.value' ELSE 'value' END || ': string instead of double'
    WHEN event_id % 13 = 5 THEN CASE WHEN event_type IN ('purchase', 'signup') THEN 'missing data.value' ELSE 'missing value' END
    END AS error
  FROM frame_events WHERE batch_no % 8 < 5),
handled AS (
  SELECT *, CASE WHEN frame_id % 97 = 50 THEN 'abort_stream' WHEN frame_id % 211 = 100 THEN 'shut_down'
    WHEN n_events = 10 THEN 'commit' ELSE 'do_not_commit' END AS action
  FROM frame_batches),
attempts AS (
  SELECT *, us + CASE WHEN "offset" % 4 = 1 THEN 86400000000 ELSE 0 END AS at_us FROM commits),
outcomes AS (
  SELECT *, CASE WHEN "offset" <= max("offset") OVER (PARTITION BY event_type, "partition" ORDER BY at_us, "offset"
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 'outdated' ELSE 'committed' END AS result
  FROM attempts),
compacted AS (
  SELECT event_type, "partition", key, max("offset") AS "offset", arg_max(eid, "offset") AS eid FROM log GROUP BY ALL),
"""

_PUBLISH = """
to_publish AS (
  SELECT event_id // 50 AS batch_id, event_id % 50 AS pos, event_id, eid, us, event_type,
    CASE WHEN event_id % 503 = 1 THEN '99' ELSE "partition" END AS "partition",
    CASE WHEN event_id % 1009 = 7 THEN 'missing value'
         WHEN event_id % 1013 = 11 THEN 'value: string instead of double'
         WHEN event_id % 499 = 3 THEN 'event type is not the target' END AS invalid,
    CASE WHEN event_id % 997 = 5 THEN 'may not overwrite version' END AS overwrites,
    CASE WHEN event_id % 503 = 1 THEN 'unknown partition 99' END AS unplaced
  FROM ev),
reasons AS (
  SELECT *, coalesce(invalid, overwrites, unplaced) AS reason,
    CASE WHEN invalid IS NOT NULL THEN 'validating' WHEN overwrites IS NOT NULL THEN 'enriching'
         WHEN unplaced IS NOT NULL THEN 'partitioning' END AS failed_step,
    "partition" = '3' AND batch_id % 5 = 0 AS lost
  FROM to_publish),
flags AS (
  SELECT *, bool_or(reason IS NOT NULL) OVER (PARTITION BY batch_id) AS bad, bool_or(lost AND unplaced IS NULL) OVER (PARTITION BY batch_id) AS some_lost
  FROM reasons),
judged AS (
  SELECT *,
    CASE WHEN reason IS NOT NULL THEN 'failed' WHEN bad THEN 'aborted' WHEN lost THEN 'failed' ELSE 'submitted' END AS publishing_status,
    CASE WHEN bad THEN 422 WHEN some_lost THEN 207 ELSE 200 END::BIGINT AS code,
    CASE WHEN reason IS NOT NULL THEN failed_step WHEN bad THEN 'none' ELSE 'publishing' END AS step,
    CASE WHEN NOT bad AND lost THEN 'write failed' ELSE reason END AS detail
  FROM flags),
"""

_HASH = """
crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, u:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 15564440312192434176::UBIGINT) ELSE c >> 1 END)) AS tb),
"""


def _hashed(source: str, key: str, columns: str) -> str:
    """CTEs ``hashed`` with the unsigned hash of ``key`` over rows of ``source``."""
    return f"""
keyed AS (SELECT {columns}, {key} AS hash_key, hex(encode({key})) AS hx, octet_length(encode({key})) AS nb FROM {source}),
hashed AS (
  SELECT {columns}, hash_key, xor(list_reduce(
      list_concat([18446744073709551615::UBIGINT],
        list_transform(range(8), lambda i: ((nb >> (8 * i)) & 255)::UBIGINT),
        list_transform(range(1, nb + 1), lambda i: ('0x' || hx[2 * i - 1 : 2 * i])::UBIGINT)),
      lambda a, x: xor(tb[((xor(a, x) & 255) + 1)::BIGINT], a >> 8)), 18446744073709551615::UBIGINT) AS hash
  FROM keyed, crc)
"""


_SETTLED = """
settled AS (
  SELECT *, CASE WHEN frame_id > stop THEN 'held_back' WHEN action IN ('abort_stream', 'shut_down') THEN 'stopped'
    WHEN action = 'commit' THEN 'committed' ELSE 'not_committed' END AS settled
  FROM (SELECT *, min(CASE WHEN action IN ('abort_stream', 'shut_down') THEN frame_id END)
      OVER (PARTITION BY stream_id, {scope}) AS stop FROM handled))
"""

_DELTAS = """
changes AS (
  SELECT stream_id, started_us AS at_us, frame_id * 3 AS seq, 1 AS b, n_events AS e, n_bytes AS y, 1 AS ub, n_events AS ue
  FROM line_bytes WHERE kind = 'batch'
  UNION ALL SELECT stream_id, completed_us, frame_id * 3 + 1, -1, -n_events, -n_bytes, 0, 0 FROM line_bytes WHERE kind = 'batch'
  UNION ALL SELECT stream_id, completed_us + 5000000, frame_id * 3 + 2, 0, 0, 0, -1, -n_events
  FROM line_bytes WHERE kind = 'batch' AND frame_id % 10 <> 0)
"""


def _cut(seconds: int | None, cursors: int, events: int, safe_secs: int) -> str:
    """Commits cut one cursor after the other: a recursion along each stream."""
    interval = "NULL" if seconds is None else str(seconds * 1_000_000)
    never = 1 << 62
    restart = f"coalesce({{at}} + {interval}, {never})"
    first_clock = never if seconds is None else 0
    return f"""
arrivals AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY frame_id) AS i FROM frame_batches),
walk AS (
  SELECT stream_id, 0::BIGINT AS i, 0::BIGINT AS frame_id, 0::BIGINT AS nb, 0::HUGEINT AS ne, {never}::BIGINT AS deadline,
    {first_clock}::BIGINT AS clock, 0::BIGINT AS commit_no, NULL::VARCHAR AS before, NULL::BIGINT AS before_at,
    NULL::VARCHAR AS here, NULL::BIGINT AS here_at
  FROM (SELECT DISTINCT stream_id FROM arrivals)
  UNION ALL
  SELECT stream_id, i, frame_id, CASE WHEN here IS NULL THEN nb ELSE 0 END, CASE WHEN here IS NULL THEN ne ELSE 0 END,
    CASE WHEN here IS NULL THEN deadline ELSE {never} END,
    CASE WHEN here IS NULL THEN clock ELSE {restart.format(at="here_at")} END,
    commit_no, before, before_at, here, here_at
  FROM (
    SELECT *, CASE WHEN here IS NOT NULL THEN completed_us END AS here_at FROM (
      SELECT *, CASE WHEN deadline <= completed_us THEN 'deadline' WHEN ne >= {events} THEN 'events'
          WHEN nb >= {cursors} THEN 'batches' WHEN clock <= completed_us THEN 'deadline' END AS here
      FROM (
        SELECT stream_id, i, frame_id, completed_us,
          CASE WHEN expired THEN 1 ELSE nb + 1 END AS nb,
          CASE WHEN expired THEN n_events ELSE ne + n_events END AS ne,
          CASE WHEN expired THEN started_us + {safe_secs * 1_000_000}
               ELSE least(deadline, started_us + {safe_secs * 1_000_000}) END AS deadline,
          CASE WHEN expired THEN {restart.format(at="due")} ELSE clock END AS clock,
          CASE WHEN nb = 0 OR expired THEN commit_no + 1 ELSE commit_no END AS commit_no,
          CASE WHEN expired THEN 'deadline' END AS before, CASE WHEN expired THEN due END AS before_at
        FROM (
          SELECT w.*, a.* EXCLUDE (stream_id, i, frame_id), a.i AS next_i, a.frame_id AS next_frame,
            least(w.deadline, w.clock) AS due, w.nb > 0 AND least(w.deadline, w.clock) < a.completed_us AS expired
          FROM walk w JOIN arrivals a ON a.stream_id = w.stream_id AND a.i = w.i + 1
        ) s(stream_id, old_i, old_frame, nb, ne, deadline, clock, commit_no, b0, b1, h0, h1,
            event_type, "partition", batch_no, "offset", seen_us, n, line_no, line_kind, started_us, n_events, completed_us,
            kind, has_info, i, frame_id, due, expired))))),
closings AS (
  SELECT stream_id, commit_no, here AS trigger, here_at AS triggered_us FROM walk WHERE here IS NOT NULL
  UNION ALL SELECT stream_id, commit_no - 1, before, before_at FROM walk WHERE before IS NOT NULL),
cut AS (
  SELECT a.*, w.commit_no, coalesce(c.trigger, 'stream_end') AS trigger, c.triggered_us
  FROM arrivals a JOIN walk w ON w.stream_id = a.stream_id AND w.i = a.i
  LEFT JOIN closings c ON c.stream_id = w.stream_id AND c.commit_no = w.commit_no)
"""


_AFTER = _cut(20_000, 6, 45, 30_000)
_LATEST = _cut(None, 1 << 61, 1 << 61, 30_000)


def _sql(select: str, *more: str) -> str:
    ctes = _TABLES + "".join(more)
    return ctes.rstrip().rstrip(",") + "\n" + select


def _plain(select: str) -> str:
    return _sql(select)


ORACLE: dict[str, str] = {
    "unconsumed_per_event_type": _plain(
        """SELECT event_type, CAST(sum(unconsumed) AS BIGINT) AS unconsumed, coalesce(sum(unconsumed) = 0, false) AS all_consumed
        FROM stats GROUP BY event_type"""
    ),
    "partition_info": _plain("SELECT * FROM info"),
    "partition_stats": _plain("SELECT * FROM stats"),
    "unconsumed_of_stream": _plain(
        """SELECT event_type, CAST(sum(unconsumed) FILTER (WHERE stream_id = 'stream-1') AS BIGINT) AS unconsumed
        FROM stats GROUP BY event_type"""
    ),
    "unconsumed_of_subscription": _plain(
        """SELECT 'sub-1' AS subscription_id, CAST(sum(unconsumed) AS BIGINT) AS unconsumed,
        coalesce(sum(unconsumed) = 0, false) AS all_consumed FROM stats"""
    ),
    "subscription_stats_report": _plain(
        "SELECT event_type, CAST(coalesce(sum(unconsumed), 0) AS BIGINT) AS unconsumed FROM stats GROUP BY event_type"
    ),
    "cursor_lag": _plain(
        """SELECT event_type, "partition", committed AS cursor_offset, newest, newest - committed AS lag
        FROM stats WHERE committed IS NOT NULL"""
    ),
    "cursor_lag_after_compaction": _plain(
        """SELECT c.event_type, c."partition", c."offset" AS cursor_offset, max(l."offset") AS newest,
        count(*) FILTER (WHERE l."offset" > c."offset") AS lag
        FROM commits c JOIN compacted l USING (event_type, "partition") GROUP BY ALL"""
    ),
    "cursor_distance": _plain(
        """SELECT pair, event_type AS initial_event_type, "partition" AS initial_partition, i AS initial_offset,
        event_type AS final_event_type, fp AS final_partition, f AS final_offset,
        CASE WHEN fp <> "partition" THEN 'different partitions' WHEN f < i THEN 'final cursor is before initial cursor' END AS error,
        CASE WHEN fp = "partition" AND f >= i THEN f - i END AS distance
        FROM (
          SELECT 'committed_to_newest' AS pair, *, committed AS i, newest AS f, "partition" AS fp FROM stats WHERE committed IS NOT NULL
          UNION ALL SELECT 'newest_to_committed', *, newest, committed, "partition" FROM stats WHERE committed IS NOT NULL
          UNION ALL SELECT 'other_partition', *, committed, newest, 'other' FROM stats WHERE committed IS NOT NULL)"""
    ),
    "time_lag": _plain(
        f"""SELECT event_type, "partition", min(us) FILTER (WHERE "offset" > coalesce(committed, -1)) AS oldest_pending_us,
        ({_AS_OF} - min(us) FILTER (WHERE "offset" > coalesce(committed, -1))) // 1000000 AS lag_seconds
        FROM log LEFT JOIN committed USING (event_type, "partition") GROUP BY ALL"""
    ),
    "subscribed_events": _plain(
        """SELECT event_type, "partition", "offset", eid FROM log LEFT JOIN committed USING (event_type, "partition")
        WHERE event_type IN ('click', 'view') AND CAST("partition" AS INTEGER) % 2 = 1
        AND "offset" > coalesce(committed // 2, -1)"""
    ),
    "events_by_start_position": _plain(
        """SELECT 'begin' AS start, event_type, count(*) AS n_events FROM log GROUP BY ALL
        UNION ALL SELECT 'cursors', event_type, count(*) FROM log LEFT JOIN committed USING (event_type, "partition")
        WHERE "offset" > coalesce(committed, -1) GROUP BY ALL"""
    ),
    "retained_events": _plain(
        f"""SELECT event_type, "partition", "offset", eid FROM log WHERE us >= {_AS_OF} - 7 * 86400000000"""
    ),
    "compacted_log": _plain(
        """SELECT event_type, "partition", key, "offset", eid FROM (
          SELECT event_type, "partition", keyed AS key, "offset", eid,
            max("offset") OVER (PARTITION BY event_type, "partition", keyed) AS newest
          FROM (SELECT *, CASE WHEN event_id % 7 <> 0 THEN key END AS keyed FROM log))
        WHERE key IS NULL OR event_type = 'view' OR "offset" = newest"""
    ),
    "compacted_increment": _plain('SELECT event_type, "partition", key, "offset", eid FROM compacted'),
    "first_receptions": _plain('SELECT eid, event_type, "partition", "offset", us AS received_us FROM log'),
    "limited_stream": _plain(
        """SELECT event_type, "partition", "offset" FROM log ORDER BY us, event_type, "partition", "offset" LIMIT 1000"""
    ),
    "cursor_forms": _plain(
        """SELECT event_type, "partition", "offset", event_type AS read_event_type, "partition" AS read_partition,
        CASE WHEN "offset" % 3 = 0 THEN -1 ELSE "offset" END AS read_offset, 'begin' AS begin_offset FROM log"""
    ),
    "parsed_lines": _plain(
        """SELECT stream_id, frame_id, event_type, "partition", "offset", 'token-' || CAST("offset" AS VARCHAR) AS cursor_token,
        CAST(n_events AS INTEGER) AS n_events, kind, has_info,
        CASE WHEN has_info THEN '{"debug":"batch ' || CAST(batch_no AS VARCHAR) || '"}' END AS info FROM lines"""
    ),
    "line_kinds": _plain(
        """SELECT stream_id, kind, has_info, count(*) AS n_lines, CAST(sum(n_events) AS BIGINT) AS n_events
        FROM lines GROUP BY ALL"""
    ),
    "lines_from_text_files": _plain(
        """SELECT stream_id, frame_id, event_type, "partition", "offset", CAST(n_events AS BIGINT) AS n_events FROM lines"""
    ),
    "quarantined_lines": _plain(
        """SELECT stream_id, frame_id, CASE batch_no % 8 WHEN 5 THEN 'no cursor cursor_token' WHEN 6 THEN 'no cursor partition'
        ELSE 'not a JSON line' END AS problem FROM lines WHERE batch_no % 8 >= 5"""
    ),
    "exploded_events": _plain(
        'SELECT stream_id, frame_id, CAST(pos AS INTEGER) AS pos, eid, event_type, "partition" FROM frame_events'
    ),
    "business_events": _plain(
        """SELECT eid, value, k, event_type, "partition", us AS occurred_us, '1.0.0' AS version,
        'flow-' || CAST(event_id AS VARCHAR) AS flow_id, 0::BIGINT AS n_parents
        FROM log WHERE event_type NOT IN ('purchase', 'signup')"""
    ),
    "data_change_events": _plain(
        """SELECT eid, value, k, event_type AS data_type, substr('CUDS', CAST(event_id % 4 AS INTEGER) + 1, 1) AS data_op,
        ['create', 'update', 'delete', 'snapshot'][CAST(event_id % 4 AS INTEGER) + 1] AS data_op_name
        FROM log WHERE event_type IN ('purchase', 'signup')"""
    ),
    "decode_errors": _plain(
        "SELECT stream_id, frame_id, CAST(pos AS INTEGER) AS pos, error, eid FROM corrupt_events WHERE error IS NOT NULL"
    ),
    "decode_failures_per_batch": _plain(
        """SELECT stream_id, frame_id, count(error) AS n_failed, count(*) AS n_events FROM corrupt_events GROUP BY ALL"""
    ),
    "line_bytes": _plain("SELECT stream_id, frame_id, n_bytes, n_events_bytes FROM line_bytes"),
    "assembled_bodies": _plain(
        """SELECT event_type, "partition", "offset" // 50 AS batch_no, count(*) AS n_events,
        octet_length(encode('[' || string_agg(event, ',' ORDER BY "offset") || ']')) AS n_bytes,
        md5('[' || string_agg(event, ',' ORDER BY "offset") || ']') AS digest
        FROM (SELECT * EXCLUDE (batch_no) FROM event_texts) GROUP BY ALL"""
    ),
    "republished_metadata": _plain(
        """SELECT eid, event_type, us AS occurred_us, 0::BIGINT AS n_parents, NULL::VARCHAR AS "partition",
        'flow-' || CAST(event_id AS VARCHAR) AS flow_id FROM log"""
    ),
    "new_event_metadata": _plain(
        "SELECT eid, us AS occurred_us, 0::BIGINT AS n_parents, NULL::VARCHAR AS event_type FROM ev"
    ),
    "key_hashes": _sql(
        "SELECT event_id, hash_key AS key, CAST(hash AS VARCHAR) AS hash FROM hashed",
        _HASH,
        _hashed("ev", "'user-' || key || '-é'", "event_id"),
    ),
    "partitions_by_key": _sql(
        'SELECT event_id, CAST(hash % 12 AS VARCHAR) AS "partition" FROM hashed', _HASH, _hashed("ev", "key", "event_id")
    ),
    "partitions_by_compound_key": _sql(
        "SELECT event_id, CAST(hash % 8 AS VARCHAR) AS assigned FROM hashed",
        _HASH,
        _hashed(
            "ev",
            "CAST(length(event_type) AS VARCHAR) || ':' || event_type || CAST(length(key) AS VARCHAR) || ':' || key",
            "event_id",
        ),
    ),
    "random_partition_spread": _sql(
        """SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN CAST(hash % 8 AS VARCHAR) END AS assigned,
        CASE WHEN event_id % 50 = 0 THEN 'no eid' END AS rejection FROM hashed""",
        _HASH,
        _hashed("ev", "eid", "event_id"),
    ),
    "partitions_by_own_hash": _plain(
        """SELECT event_id, CAST((length(key) * 31 + ascii(key) + ascii(right(key, 1))) % 12 AS VARCHAR) AS "partition" FROM ev"""
    ),
    "user_defined_partitions": _plain(
        """SELECT event_id, CASE WHEN event_id % 50 <> 0 AND user_id % 10 < 8 THEN CAST(user_id % 10 AS VARCHAR) END AS assigned,
        CASE WHEN event_id % 50 = 0 THEN 'no partition given'
             WHEN user_id % 10 >= 8 THEN 'unknown partition ' || CAST(user_id % 10 AS VARCHAR) END AS rejection FROM ev"""
    ),
    "sorted_partition_ids": _plain(
        """SELECT 'numbers' AS ids, row_number() OVER (ORDER BY n) - 1 AS place, CAST(n AS VARCHAR) AS "partition"
        FROM (SELECT DISTINCT user_id % 30 AS n FROM ev)
        UNION ALL SELECT 'texts', row_number() OVER (ORDER BY p) - 1, p
        FROM (SELECT DISTINCT 'p' || CAST(user_id % 30 AS VARCHAR) AS p FROM ev)"""
    ),
    "partition_counts": _plain(
        """SELECT event_type, count(*) % 7 + 1 AS read_parallelism, max(user_id) % 5 + 1 AS write_parallelism,
        greatest(count(*) % 7 + 1, max(user_id) % 5 + 1) AS n_partitions FROM ev GROUP BY event_type"""
    ),
    "frame_gaps": _plain(
        """SELECT stream_id, frame_id, started_us - lag(started_us) OVER w AS gap_us,
        coalesce(started_us - lag(started_us) OVER w >= 30000000, false) AS warning
        FROM lines WINDOW w AS (PARTITION BY stream_id ORDER BY frame_id)"""
    ),
    "batch_gaps": _plain(
        """SELECT stream_id, frame_id, started_us - lag(started_us) OVER (PARTITION BY stream_id ORDER BY frame_id) AS gap_us
        FROM frame_batches"""
    ),
    "in_flight_totals": _sql(
        """SELECT stream_id, seq, CAST(sum(b) OVER w AS BIGINT) AS batches_in_flight, CAST(sum(e) OVER w AS BIGINT) AS events_in_flight,
        CAST(sum(y) OVER w AS BIGINT) AS bytes_in_flight, CAST(sum(ub) OVER w AS BIGINT) AS uncommitted_batches,
        CAST(sum(ue) OVER w AS BIGINT) AS uncommitted_events, at_us
        FROM changes WINDOW w AS (PARTITION BY stream_id ORDER BY at_us, seq)""",
        _DELTAS,
    ),
    "left_over_totals": _sql(
        """SELECT *, batches_in_flight <> 0 OR events_in_flight <> 0 OR bytes_in_flight <> 0 OR uncommitted_batches <> 0
          OR uncommitted_events <> 0 AS warning
        FROM (SELECT stream_id, CAST(sum(b) AS BIGINT) AS batches_in_flight, CAST(sum(e) AS BIGINT) AS events_in_flight,
          CAST(sum(y) AS BIGINT) AS bytes_in_flight, CAST(sum(ub) AS BIGINT) AS uncommitted_batches,
          CAST(sum(ue) AS BIGINT) AS uncommitted_events FROM changes GROUP BY stream_id)""",
        _DELTAS,
    ),
    "partition_activity_intervals": _plain(
        f"""SELECT event_type, "partition", CAST(no AS BIGINT) AS interval_no, min(us) AS from_us, max(us) AS last_us, count(*) AS n_events,
        CASE WHEN max(us) + 7200000000 >= {_AS_OF} THEN greatest({_AS_OF}, max(us)) ELSE max(us) END - min(us) AS active_us
        FROM (SELECT *, sum(opens) OVER (PARTITION BY event_type, "partition" ORDER BY "offset") AS no FROM (
          SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY event_type, "partition" ORDER BY "offset") <= 7200000000 THEN 0 ELSE 1 END AS opens
          FROM log)) GROUP BY event_type, "partition", no"""
    ),
    "frame_order_per_assignment": _plain(
        """SELECT stream_id, event_type, "partition", arrival, frame_id,
        lag(frame_id) OVER w AS previous_frame_id, coalesce(frame_id > lag(frame_id) OVER w, true) AS increasing
        FROM (SELECT *, row_number() OVER (PARTITION BY stream_id
            ORDER BY completed_us + CASE WHEN frame_id % 17 = 0 THEN 400000000000 ELSE 0 END, frame_id) - 1 AS arrival
          FROM frame_batches) WINDOW w AS (PARTITION BY stream_id, event_type, "partition" ORDER BY arrival)"""
    ),
    "batches_by_count": _plain(
        """SELECT event_type, "partition", "offset" // 7 AS batch_no, count(*) AS n_events, min("offset") AS first_offset,
        max("offset") AS last_offset FROM log GROUP BY ALL"""
    ),
    "batches_by_count_after_compaction": _plain(
        """SELECT event_type, "partition", "offset",
        (row_number() OVER (PARTITION BY event_type, "partition" ORDER BY "offset") - 1) // 7 AS batch_no FROM compacted"""
    ),
    "batches_by_timespan": _sql(
        """SELECT l.event_type, l."partition", l."offset", c.no AS batch_no FROM log l
        ASOF JOIN chain c ON l.event_type = c.event_type AND l."partition" = c."partition" AND l.us >= c.anchor""",
        """
chain AS (
  SELECT event_type, "partition", min(us) AS anchor, 0::BIGINT AS no FROM log GROUP BY ALL
  UNION ALL
  SELECT c.event_type, c."partition", min(l.us), c.no + 1 FROM chain c
  JOIN log l ON l.event_type = c.event_type AND l."partition" = c."partition" AND l.us > c.anchor + 36000000000
  GROUP BY c.event_type, c."partition", c.no)""",
    ),
    "ordering_key_inversions": _plain(
        """SELECT event_type, "partition", "offset", key_place,
        key_place < max(key_place) OVER (PARTITION BY event_type, "partition" ORDER BY "offset") AS inverted
        FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY k, key, "partition", "offset") - 1 AS key_place FROM log)"""
    ),
    "coalesced_cursors": _plain(
        """SELECT stream_id, event_type, "partition", arg_max("offset", frame_id) AS "offset", min(frame_id) AS first_frame_id,
        max(frame_id) AS last_frame_id, min(started_us) AS first_us, count(*) AS n_batches, CAST(sum(n_events) AS BIGINT) AS n_events
        FROM frame_batches GROUP BY ALL"""
    ),
    "commits_immediately": _plain(
        """SELECT stream_id, frame_id AS seq, row_number() OVER (PARTITION BY stream_id ORDER BY frame_id) AS commit_no,
        'deadline' AS trigger, completed_us AS triggered_us FROM frame_batches"""
    ),
    "commits_after_limits": _sql(
        "SELECT stream_id, frame_id AS seq, commit_no, trigger, triggered_us FROM cut", _AFTER
    ),
    "commits_latest_possible": _sql(
        "SELECT stream_id, frame_id AS seq, commit_no, trigger, triggered_us FROM cut", _LATEST
    ),
    "commit_entries_with_ages": _sql(
        f"""SELECT stream_id, commit_no, event_type, "partition", "offset", first_frame_id, n_batches, n_events,
        seen_us - first_us AS first_age_us, seen_us - last_us AS last_age_us, seen_us - first_us >= 30000000000 AS warning
        FROM (SELECT stream_id, commit_no, event_type, "partition", arg_max("offset", frame_id) AS "offset",
          min(frame_id) AS first_frame_id, count(*) AS n_batches, CAST(sum(n_events) AS BIGINT) AS n_events,
          coalesce(max(triggered_us), {_AS_OF}) AS seen_us, arg_min(started_us, frame_id) AS first_us, arg_max(started_us, frame_id) AS last_us
          FROM cut GROUP BY stream_id, commit_no, event_type, "partition")""",
        _AFTER,
    ),
    "commit_trigger_metrics": _sql(
        """SELECT stream_id, trigger, count(*) AS n_commits, CAST(sum(n) AS BIGINT) AS n_batches, CAST(sum(e) AS BIGINT) AS n_events,
        max(n) AS max_batches, CAST(max(e) AS BIGINT) AS max_events
        FROM (SELECT stream_id, commit_no, trigger, count(*) AS n, sum(n_events) AS e FROM cut GROUP BY ALL) GROUP BY stream_id, trigger""",
        _AFTER,
    ),
    "commit_outcomes": _plain('SELECT event_type, "partition", "offset", at_us, result FROM outcomes'),
    "outdated_cursors": _plain("""SELECT event_type, "partition", "offset" FROM outcomes WHERE result = 'outdated'"""),
    "all_committed_per_event_type": _plain(
        "SELECT event_type, bool_and(result = 'committed') AS all_committed FROM outcomes GROUP BY event_type"
    ),
    "commit_attempt_metrics": _plain(
        """SELECT event_type, count(*) FILTER (WHERE result = 'committed') AS n_committed,
        count(*) FILTER (WHERE result <> 'committed') AS n_not_committed FROM outcomes GROUP BY event_type"""
    ),
    "commit_attempt_times": _plain(
        """SELECT outcome, count(*) AS n_attempts, count(*) AS n_cursors, CAST(sum(took_us) AS BIGINT) AS sum_took_us,
          max(took_us) AS max_took_us, true AS median_holds, true AS p95_holds
        FROM (SELECT ("offset" * 7919 + CAST("partition" AS INTEGER) * 131) % 5003 + 900 AS took_us,
            unnest(CASE WHEN "offset" % 7 = 0 THEN ['failed', last] ELSE [last] END) AS outcome
          FROM (SELECT *, CASE WHEN "offset" % 4 = 1 THEN 'not_committed' ELSE 'committed' END AS last FROM commits)) GROUP BY outcome"""
    ),
    "commits_after_reset": _plain(
        """SELECT 'sub-1' AS subscription_id, event_type, "partition", coalesce(max("offset") FILTER (WHERE
          CAST("partition" AS INTEGER) % 2 = 1 OR us > epoch_us(TIMESTAMP '2024-01-15 00:00:00')), -1) AS committed
        FROM commits GROUP BY ALL
        UNION ALL SELECT 'sub-1', event_type, "partition", max("offset") - 3 FROM log WHERE event_type = 'view' GROUP BY ALL"""
    ),
    "publish_verdicts": _sql(
        "SELECT batch_id, pos, eid, publishing_status, step, detail, code FROM judged", _PUBLISH
    ),
    "publish_stats": _sql(
        """SELECT batch_id, count(*) AS n_items, count(*) FILTER (WHERE publishing_status = 'submitted') AS n_submitted,
        count(*) FILTER (WHERE publishing_status = 'failed') AS n_failed, count(*) FILTER (WHERE publishing_status = 'aborted') AS n_aborted,
        count(*) FILTER (WHERE publishing_status <> 'submitted') AS n_not_submitted FROM judged GROUP BY batch_id""",
        _PUBLISH,
    ),
    "not_submitted_items": _sql(
        "SELECT batch_id, pos, publishing_status FROM judged WHERE publishing_status <> 'submitted'", _PUBLISH
    ),
    "publish_retry_set": _sql(
        """SELECT batch_id, pos, NULL::VARCHAR AS error FROM judged WHERE code = 207 AND publishing_status <> 'submitted'
          AND NOT (batch_id % 7 = 0 AND batch_id IN (SELECT batch_id FROM judged WHERE pos = 49))
        UNION ALL SELECT batch_id, pos, CAST(n AS VARCHAR) || ' events but ' || CAST(n - 1 AS VARCHAR) || ' responses'
        FROM (SELECT *, count(*) OVER (PARTITION BY batch_id) AS n FROM judged)
        WHERE code = 207 AND batch_id % 7 = 0 AND batch_id IN (SELECT batch_id FROM judged WHERE pos = 49)""",
        _PUBLISH,
    ),
    "publish_retry_all": _sql("SELECT batch_id, pos FROM judged WHERE code = 207", _PUBLISH),
    "publish_attempts": _sql(
        """SELECT attempt, count(*) AS n_items, count(*) FILTER (WHERE s = 'submitted') AS n_submitted,
        count(*) FILTER (WHERE s = 'failed') AS n_failed, count(*) FILTER (WHERE s = 'aborted') AS n_aborted,
        count(*) FILTER (WHERE s <> 'submitted') AS n_not_submitted
        FROM (
          SELECT 1::BIGINT AS attempt, publishing_status AS s FROM judged
          UNION ALL SELECT 2, CASE WHEN event_id % 2 = 0 THEN 'failed' ELSE 'submitted' END FROM judged
          WHERE code = 207 AND publishing_status <> 'submitted'
          UNION ALL SELECT 3, CASE WHEN event_id % 4 = 0 THEN 'failed' ELSE 'submitted' END FROM judged
          WHERE code = 207 AND publishing_status <> 'submitted' AND event_id % 2 = 0) GROUP BY attempt""",
        _PUBLISH,
    ),
    "publish_accounts": _sql(
        """SELECT batch_id, pos, outcome, attempts,
          CASE WHEN outcome = 'unpaired' THEN CAST(n AS VARCHAR) || ' events but ' || CAST(n - 1 AS VARCHAR) || ' responses'
               WHEN outcome = 'given_up' AND attempts = 0 THEN 'no response' WHEN outcome = 'given_up' THEN detail END AS error
        FROM (
          SELECT *,
            CASE WHEN code = 422 THEN 'given_up' WHEN code = 200 THEN 'submitted' WHEN short AND NOT unheard THEN 'unpaired'
                 WHEN publishing_status = 'failed' AND event_id % 4 = 0 THEN 'given_up' ELSE 'submitted' END AS outcome,
            CASE WHEN code <> 207 OR (short AND NOT unheard) THEN CASE WHEN unheard THEN 2 WHEN short AND pos = 49 THEN 0 ELSE 1 END
                 WHEN publishing_status = 'submitted' THEN CASE WHEN unheard THEN 2 ELSE 1 END
                 WHEN event_id % 2 = 0 THEN 3 ELSE 2 END::BIGINT AS attempts
          FROM (SELECT *, count(*) OVER (PARTITION BY batch_id) AS n, batch_id % 11 = 5 OR batch_id % 13 = 3 AS unheard,
                  batch_id % 7 = 0 AND max(pos) OVER (PARTITION BY batch_id) = 49 AS short FROM judged))""",
        _PUBLISH,
    ),
    "published_log": _sql(
        f"""SELECT event_type, "partition", count(*) AS n_events, {_AS_OF} AS received_us, max(eid) AS last_eid
        FROM judged WHERE publishing_status = 'submitted' GROUP BY event_type, "partition" """,
        _PUBLISH,
    ),
    "handler_outcomes": _sql(
        """SELECT stream_id, event_type, "partition", frame_id, n_events,
        CASE WHEN settled = 'held_back' THEN 'held_back' ELSE action END AS action, settled FROM settled""",
        _SETTLED.format(scope='event_type, "partition"'),
    ),
    "handler_outcomes_by_event_type": _sql(
        """SELECT stream_id, event_type, settled, count(*) AS n_batches, CAST(sum(n_events) AS BIGINT) AS n_events
        FROM settled GROUP BY ALL""",
        _SETTLED.format(scope="event_type"),
    ),
    "handled_cursors": _sql(
        """SELECT stream_id, event_type, "partition", arg_max("offset", frame_id) AS "offset", count(*) AS n_batches,
        CAST(sum(n_events) AS BIGINT) AS n_events FROM settled WHERE settled = 'committed' GROUP BY stream_id, event_type, "partition" """,
        _SETTLED.format(scope='event_type, "partition"'),
    ),
    "events_handled": _plain("SELECT event_type, count(*) AS n_events FROM log GROUP BY event_type"),
    "processing_metrics": _plain(
        """SELECT event_type, count(*) AS n_batches,
        CAST(sum(CASE WHEN action IN ('commit', 'do_not_commit') THEN h.n_events ELSE 0 END) AS BIGINT) AS n_events,
        CAST(sum(b.n_events_bytes) AS BIGINT) AS n_bytes, true AS timed
        FROM handled h JOIN line_bytes b USING (stream_id, frame_id, event_type) GROUP BY event_type"""
    ),
    "typed_handler_totals": _plain(
        """SELECT event_type, "partition", count(*) FILTER (WHERE error IS NULL) AS n_events,
        CAST(sum(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE error IS NULL) AS BIGINT) AS cents, count(error) AS n_bad
        FROM corrupt_events GROUP BY event_type, "partition" """
    ),
    "quiet_streams": _sql(
        """SELECT *, CASE WHEN missing = 'events' AND quiet_us > 40000000000 THEN 'dead'
          WHEN quiet_us >= CASE missing WHEN 'frames' THEN 10000000000 ELSE 15000000000 END THEN 'warning' END AS severity
        FROM periods WHERE quiet_us >= CASE missing WHEN 'frames' THEN 10000000000 ELSE 15000000000 END""",
        f"""
ends AS (SELECT stream_id, 'frames' AS missing, started_us AS seen_us FROM lines
  UNION ALL SELECT stream_id, 'events', started_us FROM frame_batches),
periods AS (
  SELECT *, until_us - from_us AS quiet_us FROM (
    SELECT stream_id, missing, seen_us AS from_us, coalesce(lead(seen_us) OVER (PARTITION BY stream_id, missing ORDER BY seen_us), {_AS_OF}) AS until_us
    FROM ends))""",
    ),
    "stream_metrics": _plain(
        """SELECT (started_us // 86400000000) * 86400000000 AS window_start_us, kind, count(*) AS n_frames,
        count(*) FILTER (WHERE has_info) AS n_info, CAST(sum(n_events) AS BIGINT) AS n_events, CAST(sum(n_bytes) AS BIGINT) AS n_bytes,
        max(n_bytes) AS max_bytes, CAST(sum(completed_us - started_us) AS BIGINT) AS sum_took_us,
        max(completed_us - started_us) AS max_took_us, quantile_disc(completed_us - started_us, 0.5) AS median_took_us
        FROM line_bytes GROUP BY ALL"""
    ),
    "event_type_registry": _plain(
        """SELECT asked, event_type AS name, CASE WHEN event_type IN ('purchase', 'signup') THEN 'data' ELSE 'business' END AS category,
        min(us) AS created_us, count(*) AS n_events FROM ev, (VALUES ('all'), ('purchase')) a(asked)
        WHERE asked = 'all' OR event_type = asked GROUP BY asked, event_type"""
    ),
    "subscription_list": _plain(
        """SELECT 'sub-' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS id, 'app-' || CAST(user_id % 3 AS VARCHAR) AS owning_application,
        string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types, (min(us) // 86400000000) * 86400000000 AS created_us
        FROM ev GROUP BY user_id HAVING bool_or(event_type = 'click') AND user_id % 3 = 1
        ORDER BY created_us DESC, id OFFSET 5"""
    ),
    "streamed_partition_activity": _sql(
        """SELECT event_type, "partition", 'activated' AS transition, us AS at_us, NULL::BIGINT AS active_us FROM seq WHERE opens = 1
        UNION ALL SELECT event_type, "partition", 'deactivated', max(us), max(us) - min(us) FROM numbered GROUP BY event_type, "partition", no
        HAVING max(us) < (SELECT max(us) // 1000 * 1000 FROM ev) - 7200000000 + CASE WHEN no < any_value(last_no) THEN 1000000000000 ELSE 0 END""",
        """
seq AS (
  SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY event_type, "partition" ORDER BY "offset") <= 7200000000 THEN 0 ELSE 1 END AS opens FROM log),
numbered AS (
  SELECT *, max(no) OVER (PARTITION BY event_type, "partition") AS last_no FROM (
    SELECT *, sum(opens) OVER (PARTITION BY event_type, "partition" ORDER BY "offset") AS no FROM seq))""",
    ),
    "streamed_liveness": _sql(
        """SELECT stream_id, severity, missing, from_us AS last_us FROM periods
        JOIN (VALUES ('warning', 'frames', 10000000000), ('warning', 'events', 15000000000), ('dead', 'events', 40000000001))
          l(severity, missing, quiet_limit) USING (missing) WHERE quiet_us >= quiet_limit""",
        """
ends AS (SELECT stream_id, 'frames' AS missing, started_us AS seen_us FROM lines
  UNION ALL SELECT stream_id, 'events', started_us FROM frame_batches),
periods AS (
  SELECT *, until_us - from_us AS quiet_us FROM (
    SELECT stream_id, missing, seen_us AS from_us, least(
      coalesce(lead(seen_us) OVER (PARTITION BY stream_id, missing ORDER BY seen_us), (SELECT max(started_us) // 1000 * 1000 FROM lines)),
      9000000000000000) AS until_us
    FROM ends))""",
    ),
    "streamed_handler_slots": _sql(
        """SELECT event_type, "partition", 'created' AS what, started_us AS at_us FROM slots
          WHERE before_us IS NULL OR (started_us - before_us > 86400000000 AND before_frame % 2 = 1)
        UNION ALL SELECT event_type, "partition", CASE WHEN frame_id % 2 = 0 THEN 'kept' ELSE 'killed' END, started_us FROM slots
          WHERE coalesce(next_us, (SELECT max(started_us) // 1000 * 1000 FROM frame_batches)) - started_us > 86400000000""",
        """
slots AS (
  SELECT *, lag(started_us) OVER w AS before_us, lag(frame_id) OVER w AS before_frame, lead(started_us) OVER w AS next_us
  FROM frame_batches WINDOW w AS (PARTITION BY event_type, "partition" ORDER BY frame_id))""",
    ),
    "streamed_first_receptions": _plain("SELECT eid, us AS received_us FROM ev"),
    "streamed_commits": _plain(
        """SELECT event_type, "partition", NULL::BIGINT AS committed, '001-0001-' || CAST(newest AS VARCHAR) AS committed_text FROM info"""
    ),
    "streamed_commits_after_reset": _plain(
        """SELECT event_type, "partition", committed, CASE WHEN committed = -1 THEN 'begin' ELSE CAST(committed AS VARCHAR) END AS committed_text
        FROM (SELECT event_type, "partition", CASE WHEN "partition" = '0' THEN -1 WHEN CAST("partition" AS INTEGER) % 2 = 0 THEN 3
          ELSE newest END AS committed FROM info)"""
    ),
    "streamed_limit": _plain("SELECT least(count(*), 777) AS n_events, least(count(*), 777) AS counted, true AS ended FROM log"),
    "streamed_stops": _sql(
        """SELECT stream_id, event_type, "partition", frame_id,
        CASE WHEN settled = 'held_back' THEN 'held_back' ELSE action END AS action, settled FROM settled""",
        _SETTLED.format(scope='event_type, "partition"'),
    ),
    "live_metrics": _plain(
        """SELECT count(*) AS frames_received, count(*) FILTER (WHERE kind = 'batch') AS batches_received,
        count(*) FILTER (WHERE kind = 'keep_alive') AS keep_alives_received, count(*) FILTER (WHERE has_info) AS infos_received,
        CAST(sum(n_events) AS BIGINT) AS events_received, CAST(sum(n_bytes) AS BIGINT) AS bytes_received, true AS each FROM line_bytes"""
    ),
    "stream_lifecycle": _plain(
        """SELECT event, 2::BIGINT AS n, 2::BIGINT AS n_runs, 0::BIGINT AS n_errors
        FROM (SELECT unnest(['started', 'connected', 'stream_ended', 'stopped']) AS event) WHERE EXISTS (SELECT 1 FROM ev)"""
    ),
}
