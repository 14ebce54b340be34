"""Ordered computations that do not depend on how rows spread over the keys.

A window over ``(event_type, partition)`` puts a whole partition into one task,
and one busy partition may hold a third of the log. The functions here cut every
key's ordered rows into *segments* of bounded size:

1. each segment computes its local part (a window over key + segment), which is written,
2. one summary row per segment is carried along the key (a window over the
   summaries only: rows / segment_rows of them),
3. what is carried into a segment is joined to its rows, which stay where they are.

So the input is evaluated once and its rows are shuffled once.

Where a segment cannot be summarised before its entry state is known
(:func:`carry_scan`), segments run in parallel from an assumed state and are run
again only where the assumption was wrong.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from tidelog.operators.joins import join_null_safe, join_small
from tidelog.session import stored

SEGMENT_ROWS = 1_000_000
# Segments of frames, whose texts may come along.
FRAME_ROWS = 50_000
# Segments that go through Python are held there as a whole.
CARRY_ROWS = 200_000
# Segments of which two numbers a row are packed into arrays.
CUT_ROWS = 100_000
_SEG = "_segment"


def position_segment(position: str | Column, segment_rows: int = SEGMENT_ROWS) -> Column:
    """Segment of a row that carries a gapless or nearly gapless integer position.

    Segments hold at most ``segment_rows`` rows whatever the distribution is. Rows
    without a position share a segment of their own.
    """
    position = F.col(position) if isinstance(position, str) else position
    return F.floor(position / F.lit(segment_rows)).cast("long")


def ranged(df: DataFrame, order: Sequence[str], n: int | None = None) -> DataFrame:
    """``df`` in range partitions of ``order``, written with the partition's number as segment.

    Spark takes the bounds from a sample of its own, which decides where segments lie, not what comes out; rows of
    equal order stay together, and the number of partitions grows with the data (or is ``n``). The table is
    written because other bounds would give other segments.
    """
    parts = df.repartitionByRange(n, *order) if n else df.repartitionByRange(*order)
    return stored(parts.withColumn(_SEG, F.spark_partition_id().cast("long")), "ranged")


def segmented_scan(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    segment: Column | int | None = None,
    *,
    row_number: str | None = None,
    running_sum: Mapping[str, Column] | None = None,
    running_max: Mapping[str, Column] | None = None,
    max_before: Mapping[str, Column] | None = None,
    lag: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add running columns per key in ``order_by`` order.

    ``row_number`` names a 1-based counter; ``running_sum`` and ``running_max`` are
    inclusive of the row, ``max_before`` is the maximum of the rows before it; ``lag``
    maps a new column to the column whose previous value it takes. ``order_by`` must order the rows of a key
    totally. NULL keys form a key of their own; NULL order values and segments come first.

    ``segment`` is a column that doesn't decrease along the order. Without one (or with a number of
    segments) the segments are range partitions of key and order, see :func:`ranged`.

    ``df`` is evaluated once: the windows inside segments are written, and the last row of each
    segment is its summary. Only segments that aren't the first of their key have something carried in, so there are
    fewer such rows than segments, and rows are joined with them where they lie.
    """
    sums, lags = dict(running_sum or {}), dict(lag or {})
    earlier = dict(max_before or {})
    maxs = {**dict(running_max or {}), **earlier}
    if row_number:
        sums[row_number] = F.lit(1).cast("long")

    kept = df.columns
    if isinstance(segment, Column):
        rows = df.withColumn(_SEG, segment)
    else:
        rows = ranged(df, [*keys, *order_by], segment)
    for name, col in sums.items():
        rows = rows.withColumn(f"_s_{name}", col)
    for name, col in maxs.items():
        rows = rows.withColumn(f"_m_{name}", col)

    group = [*keys, _SEG]
    local = Window.partitionBy(*group).orderBy(*order_by)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = local.rowsBetween(Window.unboundedPreceding, -1)
    # Spread by segment even if the input comes partitioned by key already, which would
    # satisfy the windows and leave a busy key in one task.
    inside = rows.repartition(*group).select(
        *kept,
        _SEG,
        F.lead(F.lit(False), 1, True).over(local).alias("_ends"),
        *[F.sum(f"_s_{n}").over(upto).alias(f"_ls_{n}") for n in sums],
        *[F.max(f"_m_{n}").over(upto).alias(f"_lm_{n}") for n in maxs],
        *[F.max(f"_m_{n}").over(ahead).alias(f"_la_{n}") for n in earlier],
        *([F.lag(F.struct(*lags.values())).over(local).alias("_lag")] if lags else []),
    )
    inside = stored(inside, "scanned")
    along = Window.partitionBy(*keys).orderBy(_SEG)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        inside.filter("_ends")
        .select(
            *group,
            F.row_number().over(along).alias("_nth"),
            *[F.sum(f"_ls_{n}").over(before).alias(f"_cs_{n}") for n in sums],
            *[F.max(f"_lm_{n}").over(before).alias(f"_cm_{n}") for n in maxs],
            *([F.lag(F.struct(*lags.values())).over(along).alias("_prev")] if lags else []),
        )
        .filter("_nth > 1")
        .drop("_nth")
    )
    previous = F.coalesce("_lag", "_prev") if lags else None
    return join_small(inside, carry, group, "left", null_safe=True).select(
        *kept,
        *[(F.coalesce(f"_cs_{n}", F.lit(0)) + F.col(f"_ls_{n}")).alias(n) for n in sums],
        *[F.greatest(f"_cm_{n}", f"_la_{n}" if n in earlier else f"_lm_{n}").alias(n) for n in maxs],
        *[previous[c].alias(n) for n, c in lags.items()],
    )


class _Ways:
    """Pointers between the rows of one segment, for :func:`chained_cuts`: each leads to the next start."""

    def __init__(self, rows: pd.DataFrame, through_limit: bool):
        rows = rows.sort_values("_cut_at")
        self.n, self.through_limit = len(rows), through_limit
        self.levels, self.known = rows["_cut_level"].to_numpy(np.int64), rows["_cut_leveled"].to_numpy(bool)
        self.limits, self.limited = rows["_cut_limit"].to_numpy(np.int64), rows["_cut_limited"].to_numpy(bool)
        at = np.arange(self.n)
        self.reached = np.maximum(self.first_reaching(self.limits, self.limited), at)
        self.pointers = np.maximum(self.next_start(self.limits, self.limited, self.reached), at + 1)

    def first_reaching(self, limits: np.ndarray, limited: np.ndarray) -> np.ndarray:
        """How many rows lie below each limit; a level or a limit that is NULL is below none."""
        found = np.zeros(len(limits), np.int64)
        for k in reversed(range(self.n.bit_length())):
            tried = found + (1 << k)
            row = np.minimum(tried, self.n) - 1
            below = (tried <= self.n) & limited & self.known[row] & (self.levels[row] < limits)
            found = np.where(below, tried, found)
        return found

    def next_start(self, limits: np.ndarray, limited: np.ndarray, at: np.ndarray) -> np.ndarray:
        if not self.through_limit:
            return at
        row = np.minimum(at, self.n - 1)
        return at + ((at < self.n) & limited & self.known[row] & (self.levels[row] == limits))

    def last_inside(self) -> np.ndarray:
        """The row by which each row's way leaves the segment: pointers are doubled until all are there."""
        last = np.where(self.pointers < self.n, self.pointers, np.arange(self.n))
        for _ in range(self.n.bit_length()):
            last = last[last]
        return last

    def way(self, entry: int) -> list[int]:
        """The starts from ``entry`` on."""
        pointers, starts = self.pointers.tolist(), []
        while entry < self.n:
            starts.append(entry)
            entry = pointers[entry]
        return starts


def _repeated(rows: pd.DataFrame, columns: Sequence[str], n: int) -> dict[str, pd.Series]:
    """The values that all rows share, ``n`` times."""
    return {c: pd.Series([rows[c].iloc[0]] * n, dtype=object) for c in columns}


def chained_cuts(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    level: str,
    until: str,
    *,
    through_limit: bool = False,
    segment_rows: int = CUT_ROWS,
) -> DataFrame:
    """Cut each key's rows, in order of ``position``, into pieces; add ``piece`` (from 0) and ``piece_until``.

    The first row starts a piece. A piece that starts at a row with limit ``until`` ends before the first later row
    whose ``level`` reaches that limit, which starts the next one; with ``through_limit`` a row that meets the limit
    exactly still belongs to it. ``piece_until`` is the limit of the piece's first row. ``level`` must not decrease
    along the pieces' first rows: what a piece has not reached, no row before it has. Both are whole numbers.

    Which row a piece would end at is the same for a row whoever starts there, so every row gets a pointer to the
    next start, and only those on the way from the first row are real. Inside a segment pointers are doubled on
    arrays: where does each row's way leave the segment? The few rows by which ways leave are the nodes of a second,
    small table of pointers between segments, which is doubled on stored tables, so the rounds grow with the
    logarithm of the segments of a key. A segment is entered at most once; its own way follows from the entry.

    Only two numbers of each row are packed, a segment at a time; the rows stay rows and are numbered by a window.
    """
    group, kept = [*keys, _SEG], df.columns
    rows = df.withColumn(_SEG, position_segment(position, segment_rows))
    # The level of a row is the highest so far inside the segment.
    local = Window.partitionBy(*group).orderBy(position)
    place = Window.partitionBy(*group).orderBy(position, level, until, *kept)
    rows = rows.repartition(*group).withColumn(level, F.max(level).over(local))
    rows = stored(rows.withColumn("_cut_at", F.row_number().over(place).cast("long") - 1), "levels")
    packed = rows.select(
        *group,
        "_cut_at",
        F.coalesce(F.col(level), F.lit(0)).cast("long").alias("_cut_level"),
        F.col(level).isNotNull().alias("_cut_leveled"),
        F.coalesce(F.col(until), F.lit(0)).cast("long").alias("_cut_limit"),
        F.col(until).isNotNull().alias("_cut_limited"),
    )

    along = Window.partitionBy(*keys).orderBy(_SEG)
    segments = rows.groupBy(*group).agg(F.max(level).cast("long").alias("top"))
    segments = stored(
        segments.select(
            *group,
            F.max("top").over(along).alias("top"),
            F.lead(_SEG).over(along).alias("following"),
            (F.row_number().over(along) == 1).alias("opens"),
        ),
        "segments",
    )
    entries = segments.filter("opens").select(*group, F.lit(0).cast("long").alias("entry"))
    if not segments.filter("following is not null").isEmpty():
        entries = stored(entries.unionByName(_entries(packed, segments, keys, through_limit)), "entries")

    kinds = [packed.schema[c] for c in group]
    schema = T.StructType([*kinds, *[T.StructField(c, T.LongType()) for c in ("_cut_at", "_cut_until")]])

    def starts_of(pdf: pd.DataFrame, edf: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or edf.empty:
            return pd.DataFrame(columns=schema.fieldNames())
        ways = _Ways(pdf, through_limit)
        at = np.array([s for entry in edf["entry"].tolist() for s in ways.way(entry)], np.int64)
        limits = pd.arrays.IntegerArray(ways.limits[at], ~ways.limited[at])
        return pd.DataFrame({**_repeated(pdf, group, len(at)), "_cut_at": at, "_cut_until": limits})

    starts = packed.groupBy(*group).cogroup(entries.groupBy(*group)).applyInPandas(starts_of, schema)
    starts = stored(starts, "starts")
    own = starts.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.max_by("_cut_until", "_cut_at").alias("_u"))
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = join_null_safe(segments.select(*group), own, group, "left").select(
        *group,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_cut_before"),
        F.last("_u", ignorenulls=True).over(before).alias("_cut_carried"),
    )
    # A start is a row of its own, just before the row it belongs to.
    both = rows.withColumn("_cut_opens", F.lit(False)).unionByName(starts.withColumn("_cut_opens", F.lit(True)), allowMissingColumns=True)
    upto = Window.partitionBy(*group).orderBy("_cut_at", F.desc("_cut_opens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.when(F.col("_cut_opens"), F.struct("_cut_until"))
    numbered = both.repartition(*group).select(
        *kept,
        _SEG,
        "_cut_opens",
        F.count(opened).over(upto).alias("_cut_rank"),
        F.last(opened, ignorenulls=True).over(upto).alias("_cut_last"),
    )
    numbered = join_small(numbered.filter("not _cut_opens"), carried, group, null_safe=True)
    limit = F.when(F.col("_cut_rank") == 0, F.col("_cut_carried")).otherwise(F.col("_cut_last._cut_until"))
    return numbered.select(
        *kept,
        (F.col("_cut_before") + F.col("_cut_rank") - 1).cast("long").alias("piece"),
        limit.cast(df.schema[until].dataType).alias("piece_until"),
    )


def _entries(packed: DataFrame, segments: DataFrame, keys: Sequence[str], through_limit: bool) -> DataFrame:
    """Where the real ways enter the segments after the first, for :func:`chained_cuts`."""
    group = [*keys, _SEG]
    kinds = [packed.schema[c] for c in group]
    number = lambda name: T.StructField(name, T.LongType())
    node_schema = T.StructType([*kinds, number("node"), number("u"), *[T.StructField(c, T.BooleanType()) for c in ("met_here", "first")]])
    hit_schema = T.StructType([*kinds, number("_from"), number("node"), number("entry"), number("to_node")])

    def leaving(pdf: pd.DataFrame) -> pd.DataFrame:
        ways = _Ways(pdf, through_limit)
        last = ways.last_inside()
        node = np.unique(last)
        return pd.DataFrame(
            {
                **_repeated(pdf, group, len(node)),
                "node": node,
                "u": pd.arrays.IntegerArray(ways.limits[node], ~ways.limited[node]),
                "met_here": ways.reached[node] < ways.n,
                "first": node == last[0],
            }
        )

    def hit(pdf: pd.DataFrame, met: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or met.empty:
            return pd.DataFrame(columns=hit_schema.fieldNames())
        ways, limits = _Ways(pdf, through_limit), met["u"].to_numpy(np.int64)
        limited = np.full(len(limits), True)
        entry = ways.next_start(limits, limited, ways.first_reaching(limits, limited))
        inside = entry < ways.n
        to_node = ways.last_inside()[np.minimum(entry, ways.n - 1)]
        return pd.DataFrame(
            {
                **_repeated(pdf, group, len(met)),
                "_from": met["_from"].to_numpy(),
                "node": met["node"].to_numpy(),
                "entry": pd.arrays.IntegerArray(entry, ~inside),
                "to_node": pd.arrays.IntegerArray(to_node, ~inside),
            }
        )

    nodes = stored(packed.groupBy(*group).applyInPandas(leaving, node_schema), "nodes")
    firsts = nodes.filter("first").select(*group, F.col("node").alias("to_node"))
    following = segments.filter("following is not null").select(*group, "following")
    # A limit met by the last row of the node's own segment: the next start is the first row of the following one.
    closing = join_null_safe(nodes.filter("met_here"), following, group).select(
        *keys, F.col("following").alias(_SEG), F.col(_SEG).alias("_from"), "node"
    )
    # Otherwise the first segment whose highest level reaches the limit.
    marks = nodes.filter("not met_here").select(*group, "node", F.col("u").alias("v"), F.lit(None).cast("long").alias("_to")).unionByName(
        segments.select(*group, F.lit(None).cast("long").alias("node"), F.col("top").alias("v"), F.col(_SEG).alias("_to"))
    )
    reaching = Window.partitionBy(*keys).orderBy(F.desc("v")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    met = marks.select(*group, "node", F.col("v").alias("u"), F.min("_to").over(reaching).alias("_to"))
    met = met.filter("node is not null and _to is not null").select(
        *keys, F.col(_SEG).alias("_from"), "node", "u", F.col("_to").alias(_SEG)
    )
    hits = stored(packed.groupBy(*group).cogroup(met.groupBy(*group)).applyInPandas(hit, hit_schema), "hits")
    # A start behind the last row of a segment is the first row of the next one.
    behind = join_null_safe(hits.filter("entry is null"), following, group).select(
        *keys, F.col("following").alias(_SEG), "_from", "node"
    )
    at_first = join_null_safe(closing.unionByName(behind), firsts, group).withColumn("entry", F.lit(0).cast("long"))
    edges = hits.filter("entry is not null").unionByName(at_first)
    edges = stored(edges.select(*keys, "_from", "node", F.col(_SEG).alias("_to"), "entry", "to_node"), "edges")
    jumps = edges.select(*keys, "_from", "node", "_to", "to_node")
    opening = segments.filter("opens").select(*group)
    reached = stored(
        join_null_safe(firsts, opening, group).select(*keys, F.col(_SEG).alias("_from"), F.col("to_node").alias("node")), "reached"
    )
    n_reached = -1
    while (count := reached.count()) != n_reached:
        n_reached = count
        step = join_null_safe(reached, jumps, [*keys, "_from", "node"]).select(
            *keys, F.col("_to").alias("_from"), F.col("to_node").alias("node")
        )
        reached = stored(reached.unionByName(step).distinct(), "reached")
        onward = jumps.select(*keys, F.col("_from").alias("_first"), F.col("node").alias("first"), F.col("_to").alias("_from"), F.col("to_node").alias("node"))
        jumps = stored(
            join_null_safe(onward, jumps, [*keys, "_from", "node"]).select(
                *keys, F.col("_first").alias("_from"), F.col("first").alias("node"), "_to", "to_node"
            ),
            "jumps",
        )
    return join_null_safe(edges, reached, [*keys, "_from", "node"], "left_semi").select(*keys, F.col("_to").alias(_SEG), "entry")


SPECULATIVE_ROUNDS = 3


def carry_scan(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    step: Callable[[pd.DataFrame, tuple | None], tuple[pd.DataFrame, tuple]],
    state: T.StructType,
    output: T.StructType,
    *,
    segment_rows: int = CARRY_ROWS,
) -> DataFrame:
    """Run a sequential rule along ``position`` within each key, segment by segment.

    ``step(rows, entry)`` gets consecutive rows in order and the state before them (None
    at the start of a key) and returns the output rows and the state after them. Output
    rows start with the key columns.

    Segments are bounded and run in parallel: first each one from None, then those whose
    true entry state differs again. A rule that forgets its past within a segment is
    through after two rounds. One that never does (say, every n-th row) depends on all
    rows before by nature: after a few rounds the keys that are not settled are passed
    through once in order, in bounded memory, to get their segments' entry states. So
    the result is always the sequential one and the work stays linear. A NULL in a key is
    a value like any other.
    """
    group = [*keys, _SEG]
    rows = df.withColumn(_SEG, position_segment(position, segment_rows))
    out_schema = T.StructType(output.fields)
    names = [f.name for f in state.fields]

    rows = stored(rows, "segments")
    exit_schema = T.StructType(
        [
            *[df.schema[k] for k in keys],
            T.StructField(_SEG, T.LongType()),
            *[T.StructField(f"x_{f.name}", f.dataType) for f in state.fields],
        ]
    )

    def entry_of(edf: pd.DataFrame) -> tuple | None:
        if edf.empty or pd.isna(edf[names[0]].iloc[0]):
            return None
        return tuple(v.item() if hasattr(v, "item") else v for v in (edf[n].iloc[0] for n in names))

    def exits(pdf: pd.DataFrame, edf: pd.DataFrame) -> pd.DataFrame:
        # A segment without an entry row is not run in this round.
        if pdf.empty or edf.empty:
            return pd.DataFrame({f.name: [] for f in exit_schema.fields})
        after = step(pdf.sort_values(position), entry_of(edf))[1]
        return pd.DataFrame([[*[pdf[c].iloc[0] for c in group], *after]], columns=exit_schema.fieldNames())

    def emit(pdf: pd.DataFrame, edf: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame({f.name: [] for f in out_schema.fields})
        return step(pdf.sort_values(position), entry_of(edf))[0]

    def pass_through(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sorted rows of whole keys → the state after each of their segments."""
        current, after = None, None
        for part in parts:
            out = []
            for head, piece in part.groupby(group, sort=False, dropna=False):
                if current is not None and head != current:
                    out.append((*current, *after))
                if current is None or head[:-1] != current[:-1]:
                    after = None
                current, after = head, step(piece, after)[1]
            yield pd.DataFrame(out, columns=exit_schema.fieldNames())
        if current is not None:
            yield pd.DataFrame([(*current, *after)], columns=exit_schema.fieldNames())

    def entries_from(done: DataFrame) -> DataFrame:
        after = F.struct(*[F.col(f"x_{n}").alias(n) for n in names])
        before = F.lag(after).over(Window.partitionBy(*keys).orderBy(_SEG))
        return done.select(*group, before.alias("_e")).select(*group, *[F.col("_e")[n].alias(n) for n in names])

    unknown = [F.lit(None).cast(f.dataType).alias(f.name) for f in state.fields]
    entries = todo = stored(rows.select(*group).distinct().select(*group, *unknown), "entries")
    done = None
    for _ in range(SPECULATIVE_ROUNDS):
        wanted = join_null_safe(rows, todo.select(*group), group, "left_semi")
        ran = wanted.groupBy(*group).cogroup(todo.groupBy(*group)).applyInPandas(exits, exit_schema)
        done = ran if done is None else join_null_safe(done, todo.select(*group), group, "left_anti").unionByName(ran)
        done = stored(done, "exits")
        old = entries.select(*group, *[F.col(n).alias(f"o_{n}") for n in names])
        entries = stored(entries_from(done), "entries")
        same = F.lit(True)
        for n in names:
            same = same & F.col(f"o_{n}").eqNullSafe(F.col(n))
        todo = stored(join_null_safe(entries, old, group).filter(~same).select(*group, *names), "todo")
        if todo.isEmpty():
            break
    else:
        open_keys = todo.select(*keys).distinct()
        in_order = (
            join_null_safe(rows, open_keys, keys, "left_semi").repartition(*keys).sortWithinPartitions(*keys, position)
        )
        passed = in_order.mapInPandas(pass_through, exit_schema)
        settled = join_null_safe(done, open_keys, keys, "left_anti")
        entries = stored(entries_from(settled.unionByName(passed)), "entries")
    return rows.groupBy(*group).cogroup(entries.groupBy(*group)).applyInPandas(emit, out_schema)
