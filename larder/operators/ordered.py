"""Order-dependent operators over groups of any size.

A plain window sends a whole group to one task. With few devices, one best-selling product
or no grouping at all, that task holds a third of the table or all of it. What depends on the
order of rows comes from :mod:`larder.operators.sweep` instead: sorted range partitions with an
exchange at their boundaries.

:func:`collapse_copies` and :func:`repeat_rows` count exact copies and unfold them again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.selection import percentiles
from larder.operators.sweep import swept

COPIES = "_copies"
BLOCK = 1 << 16


def with_previous(
    df: DataFrame, by: Sequence[str], order: Sequence[str], values: dict[str, str]
) -> DataFrame:
    """Add the values of the preceding row of the group; ``values`` maps column to new name.

    Rows that ``order`` leaves alike follow one another in any order.
    """
    return swept(df, by, order, lags=values)


def with_running_sum(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    total: str | None = None,
    descending: bool = False,
) -> DataFrame:
    """Add the sum of ``value`` up to and including the row, and optionally the group's total.

    ``order`` must be total within a group. ``descending`` runs from the last row backwards.
    """
    return with_running_sums(df, by, order, value, {out: descending}, total)


def with_running_sums(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    outputs: dict[str, bool],
    total: str | None = None,
) -> DataFrame:
    """:func:`with_running_sum` in several directions at once; ``outputs`` maps a name to whether it descends."""
    running = {out: (value, descending) for out, descending in outputs.items()}
    return swept(df, by, order, running=running, totals={total: value} if total else None)


def collapse_copies(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows with their number of copies; copies meet on the map side already."""
    keys = [F.col(f"`{c}`") for c in columns or df.columns]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES))


def has_crowds(stored: DataFrame, count: str = COPIES) -> bool:
    """Whether a stored table has a row with more than a block of copies; one column is read."""
    return not stored.filter(F.col(count) > BLOCK).isEmpty()


def repeat_rows(df: DataFrame, count: str = COPIES, index: str = "_copy", crowds: bool = True) -> DataFrame:
    """Each row ``count`` times, numbered from 1 in ``index``; the count column goes away.

    With ``crowds``, rows with very many copies are cut into blocks that spread over the cluster, which takes ``df``
    twice. Callers that know that no row has more than a block (:func:`has_crowds`) save that.
    """
    n = F.col(count)
    number = lambda first, last: F.explode(F.sequence(first, last))
    one = F.lit(1).cast("bigint")
    if not crowds:
        return df.withColumn(index, number(one, n)).drop(count)
    few = df.filter(n <= BLOCK).withColumn(index, number(one, n))
    blocks = df.filter(n > BLOCK).withColumn("_block", number(F.lit(0).cast("bigint"), F.floor((n - 1) / BLOCK)))
    start = F.col("_block") * BLOCK + 1
    many = (
        blocks.repartition("_block", count)
        .withColumn(index, number(start, F.least(start + (BLOCK - 1), n)))
        .drop("_block")
    )
    return few.unionByName(many).drop(count)


def running_sums(df: DataFrame, column: str, by: Sequence[str], order: str, outputs: dict[str, bool]) -> DataFrame:
    """Cumulative sums per group; ``outputs`` maps a name to whether it descends. Rows with equal order share a value.

    Peers are added up first, so what is ordered is one row per (group, order value), once for all outputs.
    """
    peers = df.groupBy(*by, order).agg(F.sum(column).alias("_peer_sum"))
    sums = with_running_sums(peers, by, [order], "_peer_sum", outputs)
    keys = [*by, order]
    right = sums.select(*(F.col(f"`{c}`").alias(f"_k_{i}") for i, c in enumerate(keys)), *outputs)
    on = [F.col(f"`{c}`").eqNullSafe(F.col(f"_k_{i}")) for i, c in enumerate(keys)]
    return df.join(right, on, "left").drop(*(f"_k_{i}" for i in range(len(keys))))


def running_sum(
    df: DataFrame, column: str, by: Sequence[str], order: str, out: str, descending: bool = False
) -> DataFrame:
    """:func:`running_sums` in one direction."""
    return running_sums(df, column, by, order, {out: descending})


def percentile_cont(
    df: DataFrame, column: str, q: float, by: Sequence[str] = (), out: str = "percentile"
) -> DataFrame:
    """Exact interpolated percentile of the non-NULL values, one row per group; NULL for groups without a value.

    Found by radix selection (:mod:`larder.operators.selection`); where there are too many groups for that, equal
    values are counted and the neighbours of the wanted position found by running counts. No task ever holds a group's
    values. Runs jobs when called.
    """
    found = percentiles(df, column, {out: q}, by)
    return _percentile_by_counts(df, column, q, by, out) if found is None else found


def _percentile_by_counts(df: DataFrame, column: str, q: float, by: Sequence[str], out: str) -> DataFrame:
    value = F.col(f"`{column}`")
    counts = (
        df.filter(value.isNotNull())
        .groupBy(*by, value.cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = with_running_sum(counts, by, ["_value"], "_n", "_upto", total="_total")
    position = F.lit(float(q)) * (F.col("_total") - 1)
    low, high = F.floor(position), F.ceil(position)
    covers = lambda at: (F.col("_upto") - F.col("_n") <= at) & (at < F.col("_upto"))
    neighbours = ranked.filter(covers(low) | covers(high)).groupBy(*by).agg(
        F.max(F.when(covers(low), F.col("_value"))).alias("_low"),
        F.max(F.when(covers(high), F.col("_value"))).alias("_high"),
        F.max(position - low).alias("_part"),
    )
    result = neighbours.select(
        *by, (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias(out)
    )
    if not by:
        return result
    # Groups whose values are all missing still get a row.
    empty = df.groupBy(*by).agg(F.count(value).alias("_n")).filter("_n = 0")
    return result.unionByName(empty.select(*by, F.lit(None).cast("double").alias(out)))


def median(df: DataFrame, column: str, by: Sequence[str] = (), out: str = "median") -> DataFrame:
    """Exact interpolated median."""
    return percentile_cont(df, column, 0.5, by, out)
