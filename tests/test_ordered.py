"""Order-dependent operators against plain Python, with hot groups, copies and NULLs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import expectations as e
from larder.operators import ordered as o
from larder.operators import selection, sweep
from larder.operators.expectations import records
from larder.operators.sweep import swept
from larder.session import stage


def rows(seed: int, n: int = 600):
    """Group 'hot' holds two thirds; a third of all rows are copies of one row."""
    rng = random.Random(seed)
    made = []
    for i in range(n):
        if i % 3 == 0:
            made.append(("hot", 5, 2.0))
        else:
            group = rng.choice(["hot", "hot", "a", None, "b"])
            made.append((group, rng.choice([None, *range(30)]), rng.choice([None, 1.0, 2.0, 3.0])))
    return made


SCHEMA = "g string, k int, v double"


def last(x):
    """Sort key: NULL last."""
    return (x is None, x if x is not None else 0)


def by_group(data):
    groups = {}
    for r in data:
        groups.setdefault(r[0], []).append(r)
    return groups


@pytest.mark.parametrize("seed", [1, 2])
def test_previous_row_crosses_chunks(spark, seed):
    data = sorted({(g, k) for g, k, _ in rows(seed)}, key=lambda r: (last(r[0]), last(r[1])))
    df = spark.createDataFrame(data, "g string, k int")
    got = {(r.g, r.k): r.p for r in o.with_previous(df, ["g"], ["k"], {"k": "p"}).collect()}
    for group, members in by_group(data).items():
        keys = sorted((m[1] for m in members), key=last)
        for before, key in zip([None, *keys], keys):
            assert got[group, key] == before


def test_previous_value_may_be_null_itself(spark):
    df = spark.createDataFrame([(1, None), (2, 7), (3, None), (4, 9)], "k int, v int")
    got = {r.k: r.p for r in o.with_previous(df, [], ["k"], {"v": "p"}).collect()}
    assert got == {1: None, 2: None, 3: 7, 4: None}


@pytest.mark.parametrize("descending", [False, True])
def test_running_sum_with_peers(spark, descending):
    data = rows(3)
    df = spark.createDataFrame(data, SCHEMA)
    got = sorted(o.running_sum(df, "v", ["g"], "k", "s", descending).collect(), key=str)
    assert len(got) == len(data)
    groups = by_group(data)
    for r in got:
        upto = [
            v
            for _, k, v in groups[r.g]
            if v is not None and ((last(k) >= last(r.k)) if descending else (last(k) <= last(r.k)))
        ]
        assert r.s == (pytest.approx(sum(upto)) if upto else None)


def test_total_follows_spanning_groups(spark):
    data = sorted({(g or "none", k) for g, k, _ in rows(4) if k is not None})
    df = spark.createDataFrame(data, "g string, k int")
    found = o.with_running_sum(df, ["g"], ["k"], "k", "upto", total="_total").collect()
    sums = {g: sum(k for h, k in data if h == g) for g, _ in data}
    assert all(r._total == sums[r.g] for r in found)


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.95, 1.0])
def test_percentile_equals_the_builtin(spark, q):
    df = spark.createDataFrame(rows(5), SCHEMA).withColumn("v", F.col("v") * F.col("k"))
    want = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", q).alias("p")).collect()}
    got = {r.g: r.percentile for r in o.percentile_cont(df, "v", q, ["g"]).collect()}
    assert got.keys() == want.keys()
    assert all(got[g] == pytest.approx(want[g]) for g in want)
    total = df.agg(F.percentile("v", q)).first()[0]
    assert o.percentile_cont(df, "v", q).first()[0] == pytest.approx(total)


def test_percentile_without_values(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "g string, v double")
    assert {r.g: r.percentile for r in o.percentile_cont(df, "v", 0.5, ["g"]).collect()} == {"a": None, "b": 1.0}
    assert o.percentile_cont(df.filter("g = 'a'"), "v", 0.5).first()[0] is None
    with pytest.raises(ValueError):
        o.percentile_cont(df, "v", 1.5)


def test_copies_unfold_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(o, "BLOCK", 4)
    df = spark.createDataFrame([("a", 1), ("b", 4), ("c", 11)], "g string, _copies bigint")
    got = sorted((r.g, r._copy) for r in o.repeat_rows(df).collect())
    assert got == [("a", 1)] + [("b", i) for i in range(1, 5)] + [("c", i) for i in range(1, 12)]


@pytest.mark.parametrize("rising, strictly, step", [(True, True, None), (True, False, None), (False, True, 1), (False, False, None)])
@pytest.mark.parametrize("grouped", [True, False])
def test_monotone_checks_match_brute_force(spark, rising, strictly, step, grouped):
    data = rows(6)
    df = spark.createDataFrame(data, SCHEMA)
    check = e.expect_column_values_to_be_increasing if rising else e.expect_column_values_to_be_decreasing
    options = {"group_by": ["g"]} if grouped else {}
    found = check(df, "v", sort_column="k", strictly=strictly, step=step, **options)
    got = sorted(((r.sort_column, r.value_field, r.value_field_lag) for r in found.collect()), key=str)
    want = []
    for members in (by_group(data).values() if grouped else [data]):
        pairs = sorted(((k, v) for _, k, v in members), key=lambda r: (last(r[0]), last(r[1])))
        for (_, before), (k, v) in zip(pairs, pairs[1:]):
            if before is None or v is None:
                continue
            holds = {(True, True): v > before, (True, False): v >= before, (False, True): v < before, (False, False): v <= before}
            gap = v - before if rising else before - v
            if not (holds[rising, strictly] and (not step or gap == step)):
                want.append((k, v, before))
    assert got == sorted(want, key=str)


def test_positions_number_every_row(spark):
    data = [(g, v) for g, _, v in rows(7)]
    df = spark.createDataFrame(data, "g string, v double")
    ordered = sorted(data, key=lambda r: (last(r[0]), last(r[1])))
    found = sorted(swept(df, [], ["g", "v"], position="at").collect(), key=lambda r: r["at"])
    assert [r["at"] for r in found] == list(range(1, len(data) + 1))
    assert [(r.g, r.v) for r in found] == ordered


def test_result_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(rows(8), SCHEMA)
    seen = []
    try:
        for n in ("1", "3", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found = e.expect_select_column_values_to_be_unique_within_record(df, ["g", "k", "v"])
            seen.append(sorted(map(tuple, found.collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1] == seen[2]


def test_one_shuffle_and_no_window(spark):
    df = spark.createDataFrame(rows(9), SCHEMA)
    found = e.expect_column_values_to_be_increasing(df, "v", "k")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_sweep_matches_brute_force(spark, parts):
    """Groups over many partitions, partitions without rows, NULL and NaN groups and values, copies of one row."""
    rng = random.Random(parts)
    groups = [None, 1.5, float("nan"), 2.5, 2.5, 2.5]
    data = [(rng.choice(groups), rng.choice([None, *range(9)]), rng.choice([None, -3, 0, 7])) for _ in range(400)]
    data += [(2.5, 4, 7)] * 300
    df = spark.createDataFrame(data, "g double, k int, v int")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        running = {"up": ("v", False), "down": ("v", True)}
        found = swept(df, ["g"], ["k", "v"], {"v": "lag", "k": "klag"}, running, {"sum": "v"}, "at").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    name = lambda g: "nan" if g is not None and g != g else g
    sums = lambda xs: sum(xs) if xs else None
    want = []
    for g in {name(r[0]) for r in data}:
        mine = sorted(((k, v) for h, k, v in data if name(h) == g), key=lambda r: (last(r[0]), last(r[1])))
        there = [[v for _, v in part if v is not None] for part in (mine,)][0]
        for i, (k, v) in enumerate(mine):
            upto = [x for _, x in mine[: i + 1] if x is not None]
            rest = [x for _, x in mine[i:] if x is not None]
            before = mine[i - 1] if i else (None, None)
            want.append((g, k, v, before[1], before[0], sums(upto), sums(rest), sums(there), i + 1))
    assert sorted(((name(r.g), *r[1:]) for r in found), key=str) == sorted(want, key=str)


def test_sweep_sums_decimals_and_endless_values(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, float("inf")), ("b", 1, 2.0), ("b", 2, None)], "g string, k int, v double")
    df = df.withColumn("d", F.col("v").cast("int").cast("decimal(10,2)"))
    found = {(r.g, r.k): (r.up, r.dec) for r in swept(df.filter("k = 1"), ["g"], ["k"], running={"up": ("v", False), "dec": ("d", True)}).collect()}
    assert found["a", 1] == (1.0, 1) and found["b", 1] == (2.0, 2)
    up = {(r.g, r.k): r.up for r in swept(df.drop("d"), ["g"], ["k"], running={"up": ("v", False)}).collect()}
    assert up["a", 2] == float("inf") and up["b", 1] == 2.0 and up["b", 2] == 2.0


def test_sweep_of_nothing(spark):
    df = spark.createDataFrame([], "g string, k int")
    assert swept(df, ["g"], ["k"], {"k": "p"}, position="at").collect() == []


def test_both_directions_at_once(spark):
    df = spark.createDataFrame([(k % 2, k, k * 3) for k in range(50)], "g int, k int, v int")
    got = {r.k: (r.up, r.down) for r in o.running_sums(df, "v", ["g"], "k", {"up": False, "down": True}).collect()}
    for k in range(50):
        same = [x for x in range(50) if x % 2 == k % 2]
        assert got[k] == (sum(3 * x for x in same if x <= k), sum(3 * x for x in same if x >= k))


def test_partitions_follow_the_input(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_linenumber")
    size = sweep.input_bytes(df)
    assert size > 0
    monkeypatch.setattr(sweep, "CHUNK_BYTES", size // 9)
    kept = []
    monkeypatch.setattr(sweep, "stage", lambda d, label: kept.append(d) or stage(d, label))
    swept(df, [], ["l_orderkey"], position="at")
    assert kept[-1].select(sweep.CHUNK).distinct().count() > 4


def test_no_crowds_needs_no_second_pass(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1)], "g string, _copies long")
    assert not o.has_crowds(df)
    rows = o.repeat_rows(df, crowds=False)
    assert sorted((r.g, r._copy) for r in rows.collect()) == [("a", 1), ("a", 2), ("a", 3), ("b", 1)]
    assert "Union" not in rows._jdf.queryExecution().optimizedPlan().toString()


# percentiles by radix selection


def test_keys_sort_as_doubles_do():
    values = [float("-inf"), -1e300, -2.5, -5e-324, 0.0, 5e-324, 1.0, 1.0000000000000002, 1e300, float("inf"), float("nan")]
    keys = selection.keys_of(np.array(values))
    assert list(keys) == sorted(keys) and len(set(keys.tolist())) == len(values)
    assert selection.keys_of(np.array([-0.0]))[0] == selection.keys_of(np.array([0.0]))[0]
    assert [selection.value_of(int(k)) for k in keys[:-1]] == values[:-1]


@pytest.mark.parametrize("few", [0, 1 << 16])
def test_all_quantiles_and_groups_at_once(spark, monkeypatch, few):
    """Ranks are decided by digits alone, or early when few values are left; negative, huge, equal and missing values."""
    monkeypatch.setattr(selection, "FEW", few)
    rng = random.Random(8)
    data = [(rng.choice(["a", None, "b"]), rng.choice([rng.gauss(0, 1), rng.gauss(0, 1e9), 7.25, -0.0, None])) for _ in range(700)]
    data += [("none", None)] * 3 + [("one", 5.5)]
    df = spark.createDataFrame(data, "g string, v double")
    wanted = {"low": 0.0, "tenth": 0.1, "half": 0.5, "most": 0.93, "high": 1.0}
    got = {r.g: r for r in selection.percentiles(df, "v", wanted, ["g"]).collect()}
    want = {r.g: r for r in df.groupBy("g").agg(*(F.percentile("v", q).alias(n) for n, q in wanted.items())).collect()}
    assert got.keys() == want.keys()
    for g in want:
        for name in wanted:
            assert got[g][name] == (None if want[g][name] is None else pytest.approx(want[g][name], rel=1e-12))
    whole = selection.percentiles(df, "v", wanted).first()
    assert whole.half == pytest.approx(df.agg(F.percentile("v", 0.5)).first()[0])


def test_many_groups_are_counted_instead(spark, monkeypatch):
    monkeypatch.setattr(selection, "MAX_GROUPS", 2)
    df = spark.createDataFrame([(k % 5, float(k)) for k in range(50)], "g int, v double")
    assert selection.percentiles(df, "v", {"p": 0.5}, ["g"]) is None
    got = {r.g: r.p for r in o.percentile_cont(df, "v", 0.5, ["g"], out="p").collect()}
    assert got == {k: 22.5 + k - 0.0 for k in range(5)} or got == {k: (k + (45 + k)) / 2 for k in range(5)}


def test_repeated_keys_survive_colliding_hashes(spark, monkeypatch):
    rows = [(k, "x") for k in range(40)] + [(3, "x"), (3, "x"), (7, "x"), (None, None), (None, "y"), (None, "y")]
    df = spark.createDataFrame(rows, "a int, b string")

    def found():
        pairs = e.expect_compound_columns_to_be_unique(df, ["a", "b"]).collect()
        singles = e.unique(df, "a").collect()
        return sorted(map(str, pairs)), sorted(map(str, singles))

    plain = found()
    assert len(plain[0]) == 3 and len(plain[1]) == 2
    monkeypatch.setattr(records, "_hash", lambda keys: F.lit(1).cast("long"))
    assert found() == plain
    monkeypatch.setattr(records, "FEW_HASHES", 0)
    assert found() == plain


def test_unique_keys_are_not_shuffled(spark):
    df = spark.createDataFrame([(k, "x" * 50) for k in range(100)], "a int, b string")
    plan = e.expect_compound_columns_to_be_unique(df, ["b", "a"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan


def test_chunks_follow_decoded_rows(spark, tmp_path, monkeypatch):
    from larder.operators import sweep

    path = str(tmp_path / "same")
    spark.range(50_000).select(F.lit("device").alias("g"), F.lit(1.5).alias("v"), F.lit(2.5).alias("w")).coalesce(1).write.parquet(path)
    same = spark.read.parquet(path)
    monkeypatch.setattr(sweep, "CHUNK_BYTES", 100_000)
    # A few kilobytes as stored, 36 bytes a row as decoded.
    assert sweep.input_bytes(same) < 100_000 and sweep.chunk_count(same, same) == 18
