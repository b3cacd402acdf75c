"""Anomaly model and forecast: invariants that any correct fit meets."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import anomaly, forecast


@pytest.fixture(scope="module")
def readings(spark):
    """One device holds nearly everything; a third of all rows are copies of one reading."""
    rng = np.random.default_rng(1)
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(minutes=5 * i), "hot", float(21 + rng.normal(0, 1))) for i in range(1200)]
    rows += [(start + dt.timedelta(minutes=7 * i), "b", float(22 + rng.normal(0, 1))) for i in range(200)]
    rows += [(start, "hot", 21.5)] * 700
    rows += [(start + dt.timedelta(days=9, minutes=i), "c", 95.0 + i) for i in range(5)]
    return spark.createDataFrame(rows, "telemetry_timestamp timestamp_ntz, device_id string, temperature_c double").cache()


def test_features_match_a_sequential_pass(spark, readings):
    got = anomaly.anomaly_features(readings).collect()
    want, last = [], {}
    for t, device, temp in sorted(map(tuple, readings.collect()), key=lambda r: (r[1], r[0], r[2])):
        minutes = diff = 0.0
        if device in last:
            minutes = (t - last[device][0]).total_seconds() / 60.0
            diff = temp - last[device][1]
        want.append((t, device, temp, minutes, diff, diff / minutes if minutes > 0 else 0.0))
        last[device] = (t, temp)
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got)), sorted(want)):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:])


def test_forest_flags_the_planted_readings(readings):
    labelled = anomaly.anomaly_check(readings, n_estimators=50).cache()
    total, flagged = labelled.count(), labelled.filter("anomaly_score = -1").count()
    assert total == readings.count()
    assert 0 < flagged <= math.ceil(0.05 * total)
    planted = labelled.filter("device_id = 'c'").collect()
    assert len(planted) == 5 and all(r.anomaly_score == -1 for r in planted)
    assert all(r.anomaly_type_dominant == "Equipment Breach" and r.compliance_rate_pct == 0.0 for r in planted)


def test_forest_is_repeatable_at_any_partitioning(spark, readings):
    seen = []
    try:
        for n in ("1", "5"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            features = anomaly.anomaly_features(readings, copy_index="copy").repartition(int(n))
            labelled = anomaly.isolation_forest(features, n_estimators=20, max_samples=64)
            seen.append(sorted(tuple(r) for r in labelled.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1]


def test_samples_have_the_right_size(readings):
    features = anomaly.anomaly_features(readings, copy_index="copy")
    ids = [*readings.columns, "copy"]
    for trees, size in ((4, 100), (50, 256)):
        per_tree = anomaly._samples(features, list(anomaly.FEATURES), ids, trees, size, 3).groupBy("tree").count()
        assert {r["count"] for r in per_tree.collect()} == {size} and per_tree.count() == trees


def test_forest_on_few_or_no_rows(readings):
    features = anomaly.anomaly_features(readings)
    assert anomaly.isolation_forest(features.limit(0), n_estimators=3).count() == 0
    few = anomaly.isolation_forest(features.filter("device_id = 'c'"), n_estimators=3)
    assert few.count() == 5 and set(few.schema.names) >= {"anomaly_score", "isolation_score"}


def test_classification(spark):
    rows = [(-1, 20.0), (-1, 19.9), (1, 90.0)]
    got = anomaly.classify_anomaly(spark.createDataFrame(rows, "anomaly_score int, temperature_c double")).collect()
    assert [(r.anomaly_type_dominant, r.equipment_breach, r.compliance_rate_pct) for r in got] == [
        ("Equipment Breach", 1, 0.0),
        ("Operational Error", 0, 0.0),
        ("Normal", 0, 100.0),
    ]


def truth(i: int) -> float:
    day = dt.date(2021, 1, 1) + dt.timedelta(days=i)
    return 500 + 0.3 * i + 60 * (day.weekday() == 5) + 40 * math.sin(2 * math.pi * i / 365.25)


@pytest.fixture(scope="module")
def sales(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(900):
        day = dt.date(2021, 1, 1) + dt.timedelta(days=i)
        for store, factor in (("a", 1.0), ("b", 2.0)):
            rows += [(day, store, int(factor * (truth(i) + rng.normal(0, 8)) / 2))] * 2
    return spark.createDataFrame(rows, "order_date_id date, store_id string, quantity int").cache()


def test_forecast_recovers_trend_and_season(sales):
    out = forecast.demand_forecast(sales.filter("store_id = 'a'"), horizon=30).orderBy("ds").collect()
    assert len(out) == 930
    future = [r for r in out if r.historical_qty is None]
    assert len(future) == 30 and future[0].ds == dt.date(2021, 1, 1) + dt.timedelta(days=900)
    errors = [abs(r.forecast_qty - truth(900 + k)) / truth(900 + k) for k, r in enumerate(future)]
    assert np.mean(errors) < 0.03
    inside = [r.lower_bound <= r.historical_qty <= r.upper_bound for r in out[:900]]
    assert 0.7 < np.mean(inside) < 0.9


def test_one_fit_per_series(sales):
    out = forecast.demand_forecast(sales, by=["store_id"], horizon=5)
    means = {r.store_id: r.m for r in out.groupBy("store_id").agg(F.avg("forecast_qty").alias("m")).collect()}
    assert means["b"] / means["a"] == pytest.approx(2, rel=0.02)
    assert out.count() == 2 * 905


def test_zero_fill(spark):
    daily = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), 2.0), ("a", dt.date(2024, 1, 4), None), ("b", dt.date(2024, 5, 1), 1.0)],
        "k string, ds date, y double",
    )
    got = {(r.k, r.ds.day, r.y) for r in forecast.zero_fill_daily(daily, ["k"]).collect()}
    assert got == {("a", 1, 2.0), ("a", 2, 0.0), ("a", 3, 0.0), ("a", 4, 0.0), ("b", 1, 1.0)}


def test_walk_forward(sales):
    series = forecast.zero_fill_daily(forecast.daily_totals(sales.filter("store_id = 'a'")))
    cv = forecast.walk_forward_cv(series).cache()
    cutoffs = sorted(r.cutoff for r in cv.select("cutoff").distinct().collect())
    last = dt.date(2021, 1, 1) + dt.timedelta(days=899)
    assert cutoffs[-1] == last - dt.timedelta(days=30)
    assert (cutoffs[0] - dt.date(2021, 1, 1)).days >= 449 > (cutoffs[0] - dt.date(2021, 1, 1)).days - 30
    assert all((b - a).days == 30 for a, b in zip(cutoffs, cutoffs[1:]))
    assert cv.count() == 30 * len(cutoffs)
    assert forecast.mean_mape(cv).first().mape_pct < 6
    assert forecast.walk_forward_cv(series.filter("ds < DATE'2021-02-01'")).count() == 0


def test_smallest_rows_in_one_scan(spark):
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(-50, 50)), float(rng.normal())) for _ in range(3000)]
    df = spark.createDataFrame(rows, "_id long, v double").repartition(7)
    for size in (1, 40, 5000):
        got = sorted(map(tuple, anomaly._least(df, size, ["_id", "v"]).collect()))
        assert got == sorted(rows)[:size]
    plan = anomaly._samples(df, ["v"], ["_id", "v"], 3, 20, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1


def test_running_normal_equations_equal_a_refit():
    rng = np.random.default_rng(6)
    days = np.arange(19000.0, 19700.0)
    y = 50 + 0.2 * (days - days[0]) + 8 * np.sin(2 * np.pi * days / 7) + rng.normal(0, 3, len(days))
    model = forecast.Additive(0.10)
    prefixes = forecast.Prefixes(model, days, y)
    for cutoff, predicted, ahead in prefixes.forecasts(days[-1] - 30 - 30 * np.arange(8, -1, -1.0), 30):
        known = days <= cutoff
        x, own = prefixes.columns[known], y[known]
        refit = prefixes._at(int(known.sum()), x.T @ x, x.T @ own, float(own @ own), ahead)
        assert np.allclose(predicted, refit, rtol=1e-8, atol=1e-8)
        assert list(days[ahead]) == list(cutoff + np.arange(1, 31))


def test_walk_forward_of_a_line_with_weeks_is_exact():
    days = np.arange(19000.0, 19500.0)
    y = 200 + 0.5 * (days - days[0]) + 20 * np.sin(2 * np.pi * days / 7) + 5 * np.cos(4 * np.pi * days / 7)
    model = forecast.Additive(0.10, yearly=False)
    for _, predicted, ahead in forecast.Prefixes(model, days, y).forecasts(days[-1] - 30 - 30 * np.arange(5, -1, -1.0), 30):
        assert np.allclose(predicted, y[ahead], rtol=1e-4)


def wandering(rng, size: float, n: int = 700, ahead: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """A series whose slope changes at random times by random amounts, with a week and noise."""
    days, t = np.arange(n + ahead) + 18000.0, np.arange(n + ahead) / n
    count = rng.poisson(25 * t[-1])
    times, sizes = rng.uniform(0, t[-1], count), rng.laplace(0, size, count)
    trend = 1 + 0.5 * t + np.maximum(t[:, None] - times, 0.0) @ sizes
    return days, 100 * (trend + 0.1 * np.sin(2 * np.pi * days / 7) + rng.normal(0, 0.05, n + ahead))


@pytest.mark.parametrize("size", [0.1, 0.2])
def test_bounds_hold_four_fifths_of_the_days_ahead(size):
    rng, model, inside = np.random.default_rng(11), forecast.Additive(0.10, yearly=False), []
    for _ in range(250):
        days, y = wandering(rng, size)
        _, low, high = model.fit_predict(days[:700], y[:700], days[700:]).T
        inside.append(np.mean((low <= y[700:]) & (y[700:] <= high)))
    assert 0.75 < np.mean(inside) < 0.85


def test_bounds_are_seeded_and_widen():
    days, y = wandering(np.random.default_rng(3), 0.3)
    model = forecast.Additive(0.10)
    one, again = (model.fit_predict(days[:700], y[:700], days) for _ in range(2))
    assert np.array_equal(one, again)
    other = forecast.Additive(0.10, seed=1).fit_predict(days[:700], y[:700], days)
    assert np.array_equal(one[:, 0], other[:, 0]) and not np.array_equal(one[700:, 1], other[700:, 1])
    width = one[:, 2] - one[:, 1]
    assert np.allclose(width[:700], width[0]) and width[-5:].mean() > width[700:705].mean() > width[0]
    # The order in which days are asked for is of no account.
    assert np.allclose(model.fit_predict(days[:700], y[:700], days[::-1])[::-1], one)


@pytest.mark.parametrize("y", [[5.0], [0.0, 0.0], [1.0, 2.0, 3.0], [7.0] * 400, list(range(400))])
def test_bounds_of_short_and_noiseless_series(y):
    days = np.arange(len(y)) + 18000.0
    out = forecast.Additive(0.10).fit_predict(days, np.array(y), np.arange(len(y) + 7) + 18000.0)
    assert np.isfinite(out).all() and (out[:, 1] <= out[:, 2]).all()
