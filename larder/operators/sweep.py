"""Lags, running sums and positions in one pass over sorted partitions, with an exchange at their boundaries.

Rows are range-partitioned on (group, order) and sorted, once. A task then walks its partition with Arrow
arrays and writes, beside each row, what can be known inside the partition. What a partition needs from
its neighbours concerns its first and last group only, so two rows per partition, its edges, tell everything:
they are read back (at most ``2 * MAX_CHUNKS``), carried along the line of partitions, and joined by
partition number. No window, no second shuffle, and a group may hold any share of the rows.

Rows alike in group and order are spread by their place in the input, so a row with millions of copies is
no hot key either. Copies follow one another in the result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.session import ship_package, stage

#: Bytes of input per partition, as stored and as decoded, and the most partitions (their edges are carried by the driver).
CHUNK_BYTES, MAX_CHUNKS = 32 << 20, 100_000

#: Partition number; whether a row is its first or last one; whether it belongs to its first or last group.
CHUNK, HEAD, END, LEAD, TAIL = "_chunk", "_head", "_end", "_lead", "_tail"


@dataclass
class _State:
    """The group at the seam between two partitions, and what it has summed up so far."""

    key: tuple | None = None
    chunk: int = -1
    sums: list = field(default_factory=list)


def input_bytes(df: DataFrame) -> int:
    """Size of what the plan reads, as the optimizer knows it; sources of unknown size count as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return sum(size for size in sizes if size < 1 << 60)


def chunk_count(df: DataFrame, rows: DataFrame) -> int:
    """Partitions for ``rows``, which come from ``df``. A task holds its partition decoded, and stored columns that repeat themselves
    take next to no space, so the rows are counted too."""
    decoded = rows.count() * rows._jdf.schema().defaultSize()
    return min(-(-max(input_bytes(df), decoded) // CHUNK_BYTES), MAX_CHUNKS)


def _ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`").asc_nulls_last() for c in columns]


def _is_narrow(df: DataFrame) -> bool:
    """Whether rows come straight from their source; after a shuffle their order may differ when a task is repeated."""
    return "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before; NULL equals NULL, NaN equals NaN."""
    a, b = column.slice(0, len(column) - 1), column.slice(1)
    same = pc.fill_null(pc.equal(a, b), False)
    same = pc.or_(same, pc.and_(pc.is_null(a, nan_is_null=pa.types.is_floating(a.type)), pc.is_null(b, nan_is_null=pa.types.is_floating(a.type))))
    if pa.types.is_floating(a.type):  # NULL and NaN are two values
        same = pc.and_(same, pc.equal(pc.is_null(a), pc.is_null(b)))
    return ~same.to_numpy(zero_copy_only=False)


def _running(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums from each row's group start (``first``) up to the row."""
    if values.dtype == object or (values.dtype == np.longdouble and not np.isfinite(values).all()):
        out = np.empty_like(values)
        starts = np.append(np.unique(first), len(values))
        for a, b in zip(starts, starts[1:]):
            out[a:b] = np.cumsum(values[a:b])
        return out
    upto = np.cumsum(values)
    return upto - (upto - values)[first]


def _walk(table: pa.Table, by: Sequence[str], lags: dict[str, str], sums: Sequence[str], types: dict[str, pa.DataType]) -> pa.Table:
    """One sorted partition with local lags, and per summed column the sums from both ends of the group and its total."""
    n = table.num_rows
    new_group = np.zeros(n, bool)
    new_group[0] = True
    for name in by:
        if n > 1:
            new_group[1:] |= _changes(table.column(name).combine_chunks())
    starts = np.flatnonzero(new_group)
    group = np.cumsum(new_group) - 1
    first, last = starts[group], np.append(starts[1:], n)[group] - 1
    place = np.arange(n)
    added = {HEAD: place == 0, END: place == n - 1, LEAD: group == 0, TAIL: group == group[-1]}
    columns = {c: table.column(c) for c in table.column_names} | {c: pa.array(v) for c, v in added.items()}
    before = pa.array(place - 1, mask=new_group)
    for source, out in lags.items():
        columns[out] = table.column(source).take(before)
    for k, name in enumerate(sums):
        column = table.column(name).combine_chunks()
        there = column.is_valid().to_numpy(zero_copy_only=False)
        kind = types[name]
        if pa.types.is_decimal(kind):
            values = np.array([v or 0 for v in column.to_pylist()], object)
        else:
            wide = np.int64 if pa.types.is_integer(kind) else np.longdouble
            values = pc.fill_null(column, 0).to_numpy(zero_copy_only=False).astype(wide)
        seen = np.cumsum(there)
        up, counted = _running(values, first), seen - (seen - there)[first]
        down = _running(values[::-1], (n - 1 - last)[::-1])[::-1]
        after = counted[last] - counted + there
        for label, found, known in ((f"_up{k}", up, counted), (f"_down{k}", down, after), (f"_all{k}", up[last], counted[last])):
            found = found if found.dtype == object else found.astype(np.int64 if found.dtype == np.int64 else float)
            columns[label] = pa.array(found, kind, mask=known == 0)
    return pa.table(columns)


def _wide(kind: T.DataType) -> T.DataType:
    """Type of a sum."""
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(38, kind.scale)
    return T.LongType() if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) else T.DoubleType()


def _carry(edges: list, by: Sequence[str], n_sums: int, forward: bool) -> dict[int, _State]:
    """Per partition what its first group (last group, if not ``forward``) has in the partitions before (after) it."""
    nan = lambda v: "nan" if isinstance(v, float) and v != v else v
    plus = lambda a, b: b if a is None else a if b is None else a + b
    near, far = (0, -1) if forward else (-1, 0)
    state, found = _State(), {}
    for rows in edges if forward else reversed(edges):
        key, leaving = tuple(nan(rows[near][c]) for c in by), tuple(nan(rows[far][c]) for c in by)
        joins = state.chunk >= 0 and key == state.key
        if joins:
            found[rows[0][CHUNK]] = state
        own = [rows[far][f"_all{k}"] for k in range(n_sums)]
        goes_on = joins and rows[0][TAIL]
        sums = [plus(a, b) for a, b in zip(state.sums, own)] if goes_on else own
        state = _State(leaving, rows[0][CHUNK], sums)
    return found


def swept(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    lags: dict[str, str] | None = None,
    running: dict[str, tuple[str, bool]] | None = None,
    totals: dict[str, str] | None = None,
    position: str | None = None,
) -> DataFrame:
    """``df`` with columns that depend on the order within groups (NULL is a group; NULLs sort last).

    ``lags`` maps a column to the name of its value in the preceding row; ``running`` maps a new name to
    ``(column, descending)``, the sum from the group's start (end) up to the row; ``totals`` maps a new name to
    a column summed over the group; ``position`` names the row's number in its group, from 1. Sums skip NULLs and
    are NULL while there is no value. Whole numbers are summed exactly, doubles with an 80-bit accumulator
    per partition. Runs a job when called, for the stored partitions and their edges.
    """
    spark = df.sparkSession
    ship_package(spark)
    lags, running, totals = dict(lags or {}), dict(running or {}), dict(totals or {})
    names = df.columns
    summed = sorted({c for c, _ in running.values()} | set(totals.values()))
    rows = df
    if position:
        rows = rows.withColumn("_one", F.lit(1).cast("long"))
        summed.append("_one")
        running[position] = ("_one", False)
    place = {c: k for k, c in enumerate(summed)}
    rows = rows.withColumns({f"_v{k}": F.col(f"`{c}`").cast(_wide(rows.schema[c].dataType)) for c, k in place.items()})
    values = [f"_v{k}" for k in range(len(summed))]
    if not _is_narrow(rows):
        rows = stage(rows, "sweep-input")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(least, chunk_count(df, rows))
    at = "_at"
    keys = [*_ascending([*by, *order]), F.col(at)]
    ranged = rows.withColumn(at, F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    ranged = ranged.drop(at, "_one")

    sum_types = {v: ranged.schema[v].dataType for v in values}
    local = {c: f"_lag{k}" for k, c in enumerate(lags)}
    schema = T.StructType(ranged.schema.fields)
    schema = T.StructType([*schema.fields, T.StructField(CHUNK, T.IntegerType())])
    for flag in (HEAD, END, LEAD, TAIL):
        schema = schema.add(flag, T.BooleanType())
    for source, out in local.items():
        schema = schema.add(out, ranged.schema[source].dataType)
    for k, v in enumerate(values):
        for label in ("_up", "_down", "_all"):
            schema = schema.add(f"{label}{k}", sum_types[v])
    out_names = schema.names

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            types = {v: table.schema.field(v).type for v in values}
            found = _walk(table, by, local, values, types)
            chunk = pa.array(np.full(table.num_rows, TaskContext.get().partitionId(), np.int32))
            yield from found.append_column(CHUNK, chunk).select(out_names).to_batches(max_chunksize=50_000)

    stored = stage(ranged.mapInArrow(walk, schema), "sweep")

    keyed = stored.filter(F.col(HEAD) | F.col(END)).select(CHUNK, HEAD, TAIL, *(F.col(f"`{c}`") for c in by), *(f"_all{k}" for k in range(len(values))))
    by_chunk: dict[int, list] = {}
    for row in keyed.collect():
        by_chunk.setdefault(row[CHUNK], []).append(row)
    # Both edges, the head first; a partition of one row is its own other edge.
    edges = [sorted(by_chunk[c], key=lambda r: not r[HEAD]) for c in sorted(by_chunk)]
    ahead, behind = (_carry(edges, by, len(values), forward) for forward in (True, False))
    fields = [T.StructField(f"{side}{k}", sum_types[v]) for side in ("_before", "_after") for k, v in enumerate(values)]
    shape = T.StructType([T.StructField("_c", T.IntegerType()), T.StructField("_from", T.IntegerType()), *fields])
    none = [None] * len(values)
    carried = [
        (c, ahead[c].chunk if c in ahead else None, *(ahead[c].sums if c in ahead else none), *(behind[c].sums if c in behind else none))
        for c in sorted(ahead.keys() | behind.keys())
    ]
    # One row per partition at most, so broadcasting is safe at any size of the data.
    table = spark.createDataFrame(carried, shape)
    if lags:
        seam = F.struct(*(F.col(f"`{c}`").alias(local[c]) for c in lags)).alias("_seam")
        last = stored.filter(F.col(END)).select(F.col(CHUNK).alias("_p"), seam)
        table = table.join(F.broadcast(last), table["_from"] == last["_p"], "left").drop("_p")
    joined = stored.join(F.broadcast(table), F.col(CHUNK) == F.col("_c"), "left")

    def plus(a: Column, b: Column) -> Column:
        return F.coalesce(a + b, a, b)

    result = {out: F.when(F.col(HEAD), F.col("_seam")[local[c]]).otherwise(F.col(local[c])) for c, out in lags.items()}
    for out, (c, descending) in running.items():
        k = place[c]
        carry = F.when(F.col(TAIL), F.col(f"_after{k}")) if descending else F.when(F.col(LEAD), F.col(f"_before{k}"))
        result[out] = plus(F.col(f"_down{k}" if descending else f"_up{k}"), carry)
    for out, c in totals.items():
        k = place[c]
        whole = plus(F.col(f"_all{k}"), F.when(F.col(LEAD), F.col(f"_before{k}")))
        result[out] = plus(whole, F.when(F.col(TAIL), F.col(f"_after{k}")))
    if position:
        result[position] = result.pop(position)
    return joined.select(*(F.col(f"`{c}`") for c in names), *(column.alias(out) for out, column in result.items()))
