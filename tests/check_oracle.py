"""Run every registered query and its SQL twin side by side and compare the rows.

``python tests/check_oracle.py [--segments=N] [sf_dir] [name …]``. With ``--segments`` keys
are cut into segments of N rows and nothing counts as small, as on a big table.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = _rows(names, cur.fetchall())
    if got != want:
        extra = [r for r in got if r not in set(want)][:2] if len(got) < 50_000 else []
        missing = [r for r in want if r not in set(got)][:2] if len(got) < 50_000 else []
        return f"{len(got)} rows, want {len(want)}; extra {extra} missing {missing} columns {sorted(names)}"
    return None


def types(df, con, sql: str) -> dict:
    """Columns whose Spark type and DuckDB type differ in kind."""
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE", "int": "INTEGER"}
    spark_types = dict(df.dtypes)
    duck = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    return {c: (t, duck.get(c)) for c, t in spark_types.items() if kinds.get(t) != duck.get(c)}


if __name__ == "__main__":
    if len(sys.argv) > 1 and sys.argv[1].startswith("--segments="):
        # Defaults are taken over when the modules below are imported.
        from tidelog.operators import joins, segments

        segments.SEGMENT_ROWS = segments.CARRY_ROWS = segments.CUT_ROWS = int(sys.argv.pop(1).split("=")[1])
        joins.BROADCAST_ROWS = 5
    import __spark_entry__ as entry
    from tidelog.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    session = local_session(8)
    connection = connect(sf)
    oracle = entry.oracle_sql()
    bad = 0
    for query_name, function in entry.queries().items():
        if only and query_name not in only:
            continue
        begun = time.time()
        try:
            problem = compare(session, connection, query_name, function, oracle.get(query_name), sf)
            if problem is None and query_name in oracle:
                differ = types(function(session, sf), connection, oracle[query_name]) if not query_name.startswith("streamed") else {}
                problem = f"types {differ}" if differ else None
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {query_name} {time.time() - begun:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
