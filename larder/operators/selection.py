"""Exact percentiles by radix selection.

A double becomes a 64-bit whole number that sorts as it does. A pass counts the values by the next 16 bits of that number,
finds in the counts (at most 65,536 a group) where the wanted ranks lie, and keeps the digits; the next pass looks
only at values that begin with them. Four passes decide every rank, fewer if not many values are left. Each is one
scan with a small aggregation: no values are sorted, shuffled or stored, whatever their number, and any number
of quantiles and (up to ``MAX_GROUPS``) of groups share the passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.session import ship_package

#: Groups that the driver keeps ranks for, values that are looked at one by one at the end, and bits of a digit.
MAX_GROUPS, FEW, DIGIT = 10_000, 1 << 16, 16


def keys_of(values: np.ndarray) -> np.ndarray:
    """Whole numbers that sort as the doubles do; -0.0 is 0.0, NaN comes last."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def value_of(key: int) -> float:
    """The double of a key."""
    bits = np.int64(key)
    return float((bits ^ ((bits >> np.int64(63)) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64))


@dataclass
class _Rank:
    """An order statistic: its group, where it belongs in the result, its rank among the values with the digits found so far, these
    digits, how many such values there are, and in the end its value."""

    group: int
    slot: tuple[str, str]
    left: int
    prefix: int
    among: int
    value: float | None = None


def percentiles(df: DataFrame, column: str, quantiles: dict[str, float], by: Sequence[str] = ()) -> DataFrame | None:
    """One row per group (NULL is one) with the interpolated quantile under each name; NULL where a group has no value.

    ``None`` if there are more than ``MAX_GROUPS`` groups. Runs its jobs when called.
    """
    spark = df.sparkSession
    ship_package(spark)
    if not all(0 <= q <= 1 for q in quantiles.values()):
        raise ValueError("q must lie between 0 and 1")
    value, names = F.col(f"`{column}`"), [f"_g{k}" for k in range(len(by))]

    @F.pandas_udf("long")
    def key(values: pd.Series) -> pd.Series:
        return pd.Series(keys_of(values.to_numpy(dtype=float)))

    rows = df.select(*(F.col(f"`{c}`").alias(g) for c, g in zip(by, names)), value.cast("double").alias("_value"))
    rows = rows.select(*names, F.when(F.col("_value").isNotNull(), key("_value")).alias("_key"))
    # The first digits of all groups, and where the wanted ranks lie among them; a group without values has a line of its own.
    first = rows.groupBy(*names, F.shiftright("_key", 64 - DIGIT).alias("_digits")).agg(F.count("_key").alias("_n"))
    within = Window.partitionBy(*names)
    upto = first.withColumn("_all", F.sum("_n").over(within)).withColumn("_upto", F.sum("_n").over(within.orderBy(F.asc_nulls_first("_digits"))))
    covers = F.col("_all") == 0
    for q in quantiles.values():
        at = F.lit(float(q)) * (F.col("_all") - 1)
        for rank in (F.floor(at), F.ceil(at)):
            covers = covers | ((F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank))
    hits = upto.filter(covers).limit(MAX_GROUPS * 2 * len(quantiles) + 1).collect()
    groups: list = []
    place: dict = {}
    for h in hits:
        name = tuple("nan" if isinstance(v, float) and v != v else v for v in h[: len(names)])
        if name not in place:
            place[name] = len(groups)
            groups.append((*h[: len(names)], h["_all"]))
    if not by and not groups:
        groups.append((0,))  # no row at all
    if len(groups) > MAX_GROUPS:
        return None

    ranks = []
    for h in hits:
        k = place[tuple("nan" if isinstance(v, float) and v != v else v for v in h[: len(names)])]
        for name, q in quantiles.items():
            at = q * (h["_all"] - 1)
            for end, rank in (("low", int(np.floor(at))), ("high", int(np.ceil(at)))):
                if h["_all"] and h["_upto"] - h["_n"] <= rank < h["_upto"]:
                    ranks.append(_Rank(k, (name, end), rank - (h["_upto"] - h["_n"]), h["_digits"], among=h["_n"]))

    keyed = rows.filter(F.col("_key").isNotNull())
    if by:
        fields = [*first.schema.fields[: len(names)], T.StructField("_group", T.IntegerType())]
        numbered = spark.createDataFrame([(*g[:-1], k) for k, g in enumerate(groups)], T.StructType(fields))
        right = numbered.withColumnsRenamed({g: f"{g}_" for g in names})
        # One row per group, at most MAX_GROUPS.
        keyed = keyed.join(F.broadcast(right), [F.col(g).eqNullSafe(F.col(f"{g}_")) for g in names]).select("_group", "_key")
    else:
        keyed = keyed.select(F.lit(0).alias("_group"), "_key")
    _decide(keyed, ranks)

    found = {(r.group, *r.slot): r.value for r in ranks}
    result = []
    for k, g in enumerate(groups):
        line = list(g[:-1])
        for name, q in quantiles.items():
            low, high = found.get((k, name, "low")), found.get((k, name, "high"))
            at = q * (g[-1] - 1)
            line.append(None if low is None else low if low == high else float(low + (high - low) * (at - np.floor(at))))
        result.append(tuple(line))
    fields = [T.StructField(c, f.dataType) for c, f in zip(by, first.schema.fields)]
    return spark.createDataFrame(result, T.StructType([*fields, *(T.StructField(n, T.DoubleType()) for n in quantiles)]))


def _decide(keyed: DataFrame, ranks: list[_Rank]) -> None:
    """Find the values of all ranks, whose first digits are known; ``keyed`` has ``_group`` and ``_key``."""
    spark = keyed.sparkSession
    for level in range(1, 64 // DIGIT + 1):
        if not ranks:
            return
        known = 64 - DIGIT * level
        if not known:
            for r in ranks:
                r.value = value_of(r.prefix)
            return
        if sum({(r.group, r.prefix): r.among for r in ranks}.values()) <= FEW:
            _look(keyed, ranks, known)
            return
        table = spark.createDataFrame(sorted({(r.group, r.prefix) for r in ranks}), "_g int, _prefix long")
        # At most two ranks per group and quantile.
        on = (F.col("_group") == F.col("_g")) & (F.shiftright("_key", known) == F.col("_prefix"))
        candidates = keyed.join(F.broadcast(table), on).select("_group", "_key")
        # The digits so far and the next one, as a signed number: its order is that of the keys.
        counts = candidates.groupBy("_group", F.shiftright("_key", known - DIGIT).alias("_digits")).agg(F.count(F.lit(1)).alias("_n"))
        within = Window.partitionBy("_group", F.shiftright("_digits", DIGIT)).orderBy("_digits")
        upto = counts.withColumn("_upto", F.sum("_n").over(within))
        wanted = spark.createDataFrame(sorted({(r.group, r.prefix, r.left) for r in ranks}), "_g int, _p long, _left long")
        same = (F.col("_group") == F.col("_g")) & (F.shiftright("_digits", DIGIT) == F.col("_p"))
        here = same & (F.col("_upto") > F.col("_left")) & (F.col("_upto") - F.col("_n") <= F.col("_left"))
        hits = upto.join(F.broadcast(wanted), here).select("_g", "_p", "_left", "_digits", "_n", (F.col("_upto") - F.col("_n")).alias("_before"))
        place = {(h["_g"], h["_p"], h["_left"]): h for h in hits.collect()}
        for r in ranks:
            h = place[r.group, r.prefix, r.left]
            r.prefix, r.left, r.among = h["_digits"], r.left - h["_before"], h["_n"]


def _look(keyed: DataFrame, ranks: list[_Rank], shift: int) -> None:
    """The last few values one by one, equal ones counted."""
    table = keyed.sparkSession.createDataFrame(sorted({(r.group, r.prefix) for r in ranks}), "_g int, _prefix long")
    on = (F.col("_group") == F.col("_g")) & (F.shiftright("_key", shift) == F.col("_prefix"))
    counts = keyed.join(F.broadcast(table), on).groupBy("_g", "_prefix", "_key").agg(F.count(F.lit(1)).alias("n")).collect()
    lists: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for c in counts:
        lists.setdefault((c["_g"], c["_prefix"]), []).append((c["_key"], c["n"]))
    for place in lists.values():
        place.sort()
    for r in ranks:
        upto = 0
        for key, n in lists[r.group, r.prefix]:
            upto += n
            if upto > r.left:
                r.value = value_of(key)
                break
