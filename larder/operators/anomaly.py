"""Sensor anomalies: features, isolation forest, classification.

The forest follows Liu, Ting and Zhou, "Isolation Forest" (2008). Spark draws the samples,
grows one tree per task group and scores the readings; the driver only ever holds the
trees, at most ``2 * max_samples * n_estimators`` small nodes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.ordered import percentile_cont
from larder.operators.sweep import CHUNK_BYTES, input_bytes, swept
from larder.session import ship_package, stage

FEATURES = ("temperature_c", "duration_minutes", "delta_temp_per_minute")


def anomaly_features(readings: DataFrame, copy_index: str | None = None) -> DataFrame:
    """Minutes and temperature change since the device's previous reading, and their ratio.

    The first reading of a device has zeros. Readings of one instant are ordered by their
    values; exact copies follow each other with no change. A device may hold any share of
    the readings. ``copy_index`` names the reading's number in its device's order, which
    together with the reading's own columns identifies every row.
    """
    columns = readings.columns
    order = ["telemetry_timestamp", "temperature_c"]
    order += [c for c in columns if c not in ("device_id", *order)]
    before = {"telemetry_timestamp": "_previous_time", "temperature_c": "_previous_temperature"}
    rows = swept(readings, ["device_id"], order, before, position=copy_index)
    micros = F.timestamp_diff("MICROSECOND", F.col("_previous_time"), F.col("telemetry_timestamp"))
    minutes = micros / F.lit(1000000.0) / F.lit(60.0)
    change = F.col("temperature_c") - F.col("_previous_temperature")
    result = rows.withColumns(
        {
            "duration_minutes": F.coalesce(minutes, F.lit(0.0)),
            "temp_diff": F.coalesce(change, F.lit(0.0)),
        }
    ).withColumn(
        "delta_temp_per_minute",
        F.when(F.col("duration_minutes") > 0, F.col("temp_diff") / F.col("duration_minutes")).otherwise(
            F.lit(0.0)
        ),
    )
    added = ["duration_minutes", "temp_diff", "delta_temp_per_minute"]
    return result.select(*columns, *added, *([copy_index] if copy_index else []))


def classify_anomaly(scored: DataFrame) -> DataFrame:
    """Type, breach flag and compliance of readings labelled -1 (anomaly) or 1."""
    anomaly = F.col("anomaly_score") == -1
    kind = (
        F.when(anomaly & (F.col("temperature_c") >= 20), "Equipment Breach")
        .when(anomaly, "Operational Error")
        .otherwise("Normal")
    )
    breach = F.when(F.col("anomaly_type_dominant") == "Equipment Breach", 1).otherwise(0)
    compliance = F.when(F.col("anomaly_score") == 1, F.lit(100.0)).otherwise(F.lit(0.0))
    return scored.withColumn("anomaly_type_dominant", kind).withColumns(
        {"equipment_breach": breach, "compliance_rate_pct": compliance}
    )


# --- isolation forest ------------------------------------------------------------------

TREE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size int, depth int"


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of ``n`` leaves."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    harmonic = np.log(safe - 1.0) + np.euler_gamma
    return np.where(n > 2, 2.0 * harmonic - 2.0 * (n - 1.0) / safe, np.where(n == 2, 1.0, 0.0))


def _grow(sample: np.ndarray, tree: int, seed: int, depth_limit: int) -> pd.DataFrame:
    """One isolation tree as a table of nodes; leaves have feature -1."""
    rng = np.random.default_rng([seed, tree])
    nodes: list[list] = []
    pending = [(0, sample, 0)]
    nodes.append([tree, 0, -1, 0.0, -1, -1, len(sample), 0])
    while pending:
        at, rows, depth = pending.pop()
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (None, None)
        splittable = np.flatnonzero(high > low) if len(rows) > 1 else []
        if depth >= depth_limit or len(splittable) == 0:
            continue
        feature = int(rng.choice(splittable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        goes_left = rows[:, feature] <= threshold
        left, right = len(nodes), len(nodes) + 1
        nodes[at][2:6] = [feature, threshold, left, right]
        for child, part in ((left, rows[goes_left]), (right, rows[~goes_left])):
            nodes.append([tree, child, -1, 0.0, -1, -1, len(part), depth + 1])
            pending.append((child, part, depth + 1))
    return pd.DataFrame(nodes, columns=[c.split()[0] for c in TREE_SCHEMA.split(", ")])


def _least(rows: DataFrame, size: int, order: Sequence[str]) -> DataFrame:
    """The ``size`` rows that come first in ``order``, in one scan: a bottom-k sketch per task, merged in two steps.

    A task holds ``size`` rows and a batch. The first merge goes to as many tasks as the square root of the partitions, so
    none sees more than that many sketches.
    """
    columns, kinds = rows.columns, rows.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, count = None, [], 0
        for batch in batches:
            waiting.append(batch)
            count += batch.num_rows
            if count >= 2 * size:
                held = smallest([*waiting] if held is None else [*held.to_batches(), *waiting])
                waiting, count = [], 0
        if waiting:
            held = smallest([*waiting] if held is None else [*held.to_batches(), *waiting])
        if held is not None:
            yield from held.select(columns).to_batches()

    def smallest(batches: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(batches)
        return table.take(pc.sort_indices(table, [(c, "ascending") for c in order])[:size])

    sketches = rows.mapInArrow(keep, kinds)
    partitions = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), input_bytes(rows) // CHUNK_BYTES)
    middle = math.isqrt(partitions) + 1
    return sketches.repartition(middle).mapInArrow(keep, kinds).coalesce(1).mapInArrow(keep, kinds)


def _samples(df: DataFrame, features: Sequence[str], row_id: Sequence[str], trees: int, size: int, seed: int) -> DataFrame:
    """``size`` rows for each tree, chosen by hash so that partitioning plays no part.

    A pool of ``trees * size`` rows with the smallest hashes is a uniform sample of the table, found in one scan. In hash
    order every tree takes a stretch of the pool: stretches of their own in a full pool, overlapping ones in a smaller table.
    """
    ident = F.xxhash64(F.lit(seed), *(F.col(f"`{c}`") for c in row_id))
    order = ["_id", *features]
    rows = df.select(*(F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features), ident.alias("_id"))
    pool = _least(rows, trees * size, order)
    # The pool is small by construction, at most trees * size rows.
    whole = Window.orderBy(*order)
    placed = pool.withColumns(
        {"_at": F.row_number().over(whole) - 1, "_pool": F.count(F.lit(1)).over(Window.partitionBy())}
    )
    tree = F.col("tree")
    start = F.when(F.col("_pool") == trees * size, tree.cast("bigint") * size).otherwise(
        F.pmod(F.xxhash64(tree, F.lit(seed)), F.col("_pool"))
    )
    return (
        placed.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        .filter(F.pmod(F.col("_at") - start, F.col("_pool")) < size)
        .select("tree", *order)
    )


def _mean_paths(values: np.ndarray, forest: list[dict]) -> np.ndarray:
    """Mean isolation depth of each row over all trees."""
    total = np.zeros(len(values))
    everyone = np.arange(len(values))
    for tree in forest:
        at = np.zeros(len(values), dtype=np.int64)
        for _ in range(int(tree["depth"].max())):
            feature = tree["feature"][at]
            inner = feature >= 0
            if not inner.any():
                break
            goes_left = values[everyone, np.maximum(feature, 0)] <= tree["threshold"][at]
            at = np.where(inner, np.where(goes_left, tree["left"][at], tree["right"][at]), at)
        total += tree["depth"][at] + average_path(tree["size"][at])
    return total / len(forest)


def with_isolation_score(df: DataFrame, features: Sequence[str], forest: list[dict]) -> DataFrame:
    """``isolation_score`` of every row under given trees: 2 to the power of minus its mean depth over the usual depth.

    A tree is a dict of equally long arrays, one entry per node and the root first: ``feature`` (-1 in leaves), ``threshold``
    (values up to it go left), ``left``, ``right``, ``size`` (sample rows that came there) and ``depth``. Missing features are 0.
    """
    ship_package(df.sparkSession)
    norm = float(average_path(float(forest[0]["size"][0]))) or 1.0
    shared = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        trees = shared.value
        for columns in batches:
            values = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            paths = _mean_paths(np.nan_to_num(values, nan=0.0), trees)
            yield pd.Series(np.power(2.0, -paths / norm))

    return df.withColumn("isolation_score", score(*(F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features)))


def isolation_forest(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    contamination: float = 0.05,
    n_estimators: int = 100,
    max_samples: int = 256,
    seed: int = 42,
    row_id: Sequence[str] | None = None,
) -> DataFrame:
    """Label the most isolated share of rows -1 and the others 1, in ``anomaly_score``.

    Missing features count as 0. The raw isolation score in (0, 1] is kept as
    ``isolation_score``. ``row_id`` names the columns that tell rows apart (default:
    all); the sample is drawn by their hash. The same rows and seed give the same labels
    at any number of partitions.
    """
    ship_package(df.sparkSession)
    features = list(features)
    row_id = list(row_id or df.columns)
    sample = _samples(df, features, row_id, n_estimators, max_samples, seed)
    # The depth limit follows ``max_samples``; small tables draw fewer rows, and the norm follows those.
    depth_limit = math.ceil(math.log2(max(max_samples, 2)))

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values(["_id", *features])[features].to_numpy(dtype=float)
        return _grow(ordered, int(key[0]), seed, depth_limit)

    nodes = sample.groupBy("tree").applyInPandas(grow, TREE_SCHEMA).toPandas()
    columns = ("feature", "threshold", "left", "right", "size", "depth")
    forest = [
        {c: part[c].to_numpy() for c in columns} for _, part in nodes.sort_values(["tree", "node"]).groupby("tree")
    ]
    if not forest:
        return df.withColumns(
            {"isolation_score": F.lit(None).cast("double"), "anomaly_score": F.lit(None).cast("int")}
        )
    # Scored once, read twice: for the threshold and for the labels.
    scored = stage(with_isolation_score(df, features, forest), "scores")
    cut = percentile_cont(scored, "isolation_score", 1.0 - contamination, out="cut").scalar()
    return scored.withColumn("anomaly_score", F.when(F.col("isolation_score") > cut, -1).otherwise(1))


def anomaly_check(readings: DataFrame, contamination: float = 0.05, seed: int = 42, **forest) -> DataFrame:
    """Features, forest labels and anomaly types of all readings."""
    copy = "_copy_no"
    features = stage(anomaly_features(readings, copy_index=copy), "features")
    labelled = isolation_forest(
        features, FEATURES, contamination, seed=seed, row_id=[*readings.columns, copy], **forest
    )
    return classify_anomaly(labelled.drop(copy))
