"""Queries of the fitted models. SQL checks cover what is not fitted."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from larder.catalog.entry import Entry
from larder.catalog.sqltext import with_tables
from larder.catalog.tables import Tables
from larder.operators import anomaly, forecast, gold
from larder.session import work_path
from larder.sources.tables import Lake


def _forest(spark, sf):
    readings = Tables(spark, sf).readings
    features = anomaly.anomaly_features(readings, copy_index="copy_no")
    return anomaly.isolation_forest(features, row_id=[*readings.columns, "copy_no"])


def _zero_fill(spark, sf):
    daily = forecast.daily_totals(Tables(spark, sf).raw("events"), "ts", "event_id", ["user_id"])
    return forecast.zero_fill_daily(daily, ["user_id"])


def _cv(spark, sf):
    daily = forecast.zero_fill_daily(forecast.daily_totals(Tables(spark, sf).sales))
    return forecast.walk_forward_cv(daily)


def _retrain(spark, sf):
    lake = Lake(spark, work_path(spark, "lake"))
    forecast.retrain_and_append(lake, gold.daily_demand(Tables(spark, sf).sales))
    return lake.read("gold", "ml_demand_predictions")


def _checked_readings(spark, sf):
    """Everything about the labelled readings but the label."""
    readings = Tables(spark, sf).readings
    added = ["duration_minutes", "temp_diff", "delta_temp_per_minute"]
    return anomaly.anomaly_check(readings).select(*readings.columns, *added)


def _flagged_share(spark, sf):
    """Readings and whether about one in twenty of them is flagged."""
    flagged = F.count(F.when(F.col("anomaly_score") == -1, 1))
    readings = F.count(F.lit(1))
    labelled = anomaly.anomaly_check(Tables(spark, sf).readings)
    return labelled.agg(
        readings.alias("readings"), (F.abs(flagged / readings - 0.05) < 0.01).alias("share_is_contamination")
    )


#: A forest of two trees over a sample of 16 rows: nodes as (feature, threshold, left, right, size, depth).
GIVEN_FOREST = (
    ((0, 40.0, 1, 2, 16, 0), (1, 10.0, 3, 4, 12, 1), (-1, 0.0, -1, -1, 4, 1), (-1, 0.0, -1, -1, 9, 2), (-1, 0.0, -1, -1, 3, 2)),
    ((1, 5.0, 1, 2, 16, 0), (-1, 0.0, -1, -1, 14, 1), (0, 70.0, 3, 4, 2, 1), (-1, 0.0, -1, -1, 1, 2), (-1, 0.0, -1, -1, 1, 2)),
)


def _given_scores(spark, sf):
    """Scores of all readings under trees that are given."""
    names = ("feature", "threshold", "left", "right", "size", "depth")
    forest = [dict(zip(names, map(np.array, zip(*tree)))) for tree in GIVEN_FOREST]
    readings = Tables(spark, sf).readings.select("telemetry_timestamp", "device_id", "temperature_c", "humidity_percentage")
    scored = anomaly.with_isolation_score(readings, ["temperature_c", "humidity_percentage"], forest)
    return scored.withColumn("isolation_score", F.round("isolation_score", 9))


def _given_scores_sql() -> str:
    """The same from the definition: depth of the leaf and the usual depth of what it holds, over all trees."""
    usual = lambda n: f"(2 * (ln({n} - 1) + 0.5772156649015329) - 2 * ({n} - 1.0) / {n})" if n > 2 else "1.0" if n == 2 else "0.0"
    columns = ("temperature_c", "humidity_percentage")

    def depth(tree, k: int) -> str:
        feature, threshold, left, right, size, at = tree[k]
        if feature < 0:
            return f"({at} + {usual(size)})"
        return f"CASE WHEN COALESCE({columns[feature]}, 0) <= {threshold} THEN {depth(tree, left)} ELSE {depth(tree, right)} END"

    paths = " + ".join(f"({depth(tree, 0)})" for tree in GIVEN_FOREST)
    score = f"round(pow(2.0::DOUBLE, -(({paths}) / {len(GIVEN_FOREST)}) / {usual(GIVEN_FOREST[0][0][4])}), 9)"
    return with_tables(f"SELECT telemetry_timestamp, device_id, temperature_c, humidity_percentage, {score} AS isolation_score FROM fact_cold_chain", "fact_cold_chain")


_SERIES_SQL = (
    "series AS (SELECT CAST(d AS DATE) AS ds, COALESCE(y, 0.0) AS y FROM (SELECT UNNEST(generate_series(MIN(order_date_id), "
    "MAX(order_date_id), INTERVAL 1 DAY)) AS d FROM fact_sales) LEFT JOIN (SELECT order_date_id, CAST(SUM(quantity) AS DOUBLE) "
    "AS y FROM fact_sales GROUP BY 1) ON d = order_date_id)"
)


def _known_mape(spark, sf):
    """The metric on a forecast that needs no fit; one is added to every day so that none is without demand."""
    known = _cv(spark, sf).select("cutoff", "ds", (F.col("y") + 1).alias("y"), (F.col("y") * 0.9 + 3).alias("yhat"))
    return forecast.rolling_mape(known).withColumn("mape", F.round("mape", 9))


def _on_series(body: str) -> str:
    """SQL over the zero-filled daily series."""
    return with_tables(f"SELECT * FROM (WITH {_SERIES_SQL} {body})", "fact_sales")


ENTRIES = [
    Entry("m2_isolation_forest", _forest),
    Entry("m2_scores_of_given_trees", _given_scores, _given_scores_sql()),
    Entry(
        "m2_anomaly_check_readings", _checked_readings, with_tables("SELECT * FROM features", "features")
    ),
    Entry(
        "m2_flagged_share",
        _flagged_share,
        with_tables(
            "SELECT COUNT(*) AS readings, true AS share_is_contamination FROM fact_cold_chain", "fact_cold_chain"
        ),
    ),
    Entry(
        "m3_forecast_days",
        lambda s, f: forecast.demand_forecast(Tables(s, f).sales).select("ds", "historical_qty"),
        _on_series(
            "SELECT ds, y AS historical_qty FROM series UNION ALL SELECT CAST(m + i AS DATE), NULL FROM "
            "(SELECT MAX(ds) AS m, UNNEST(generate_series(1, 30))::INT AS i FROM series)"
        ),
    ),
    Entry(
        "m4_folds",
        lambda s, f: _cv(s, f).select("cutoff", "ds", "y"),
        _on_series(
            "SELECT cutoff, ds, y FROM series, (SELECT CAST(l - 30 - 30 * i AS DATE) AS cutoff FROM (SELECT f, l, "
            "UNNEST(range(0, 1000))::INT AS i FROM (SELECT MIN(ds) AS f, MAX(ds) AS l FROM series)) "
            "WHERE l - 30 - 30 * i >= f + CAST(GREATEST(30, (l - f) // 2) AS INT)) WHERE ds > cutoff AND ds <= cutoff + 30"
        ),
    ),
    Entry(
        "m5_predicted_days",
        lambda s, f: _retrain(s, f).select("ds"),
        with_tables(
            "SELECT CAST(m + i AS TIMESTAMP) AS ds FROM (SELECT MAX(order_date_id) AS m, UNNEST(generate_series(1, 7))::INT AS i "
            "FROM fact_sales)",
            "fact_sales",
        ),
    ),
    Entry("m2_anomaly_check", lambda s, f: anomaly.anomaly_check(Tables(s, f).readings)),
    Entry("m3_demand_forecast", lambda s, f: forecast.demand_forecast(Tables(s, f).sales)),
    Entry(
        "m3_demand_forecast_by_store",
        lambda s, f: forecast.demand_forecast(Tables(s, f).sales, by=["store_id"]),
    ),
    Entry(
        "m3a_zero_fill_daily",
        _zero_fill,
        """WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS ds, CAST(SUM(event_id) AS DOUBLE) AS y FROM events
            GROUP BY 1, 2),
          days AS (SELECT user_id, CAST(UNNEST(generate_series(MIN(ds), MAX(ds), INTERVAL 1 DAY)) AS DATE) AS ds
            FROM daily GROUP BY 1)
        SELECT d.user_id, d.ds, COALESCE(x.y, 0.0) AS y FROM days d
        LEFT JOIN daily x ON d.user_id = x.user_id AND d.ds = x.ds""",
    ),
    Entry(
        "m4_rolling_mape",
        _known_mape,
        _on_series(
            """, folds AS (SELECT ds - cutoff AS h, y + 1 AS y, 0.9::DOUBLE * y + 3 AS yhat FROM series,
              (SELECT CAST(l - 30 - 30 * i AS DATE) AS cutoff FROM (SELECT f, l, UNNEST(range(0, 1000))::INT AS i
                FROM (SELECT MIN(ds) AS f, MAX(ds) AS l FROM series))
               WHERE l - 30 - 30 * i >= f + CAST(GREATEST(30, (l - f) // 2) AS INT)) WHERE ds > cutoff AND ds <= cutoff + 30),
            errors AS (SELECT h, ROW_NUMBER() OVER (ORDER BY h) AS place,
                AVG(ABS(y - yhat) / y) OVER (PARTITION BY h) AS e FROM folds),
            ends AS (SELECT h, MAX(place) AS last, GREATEST((SELECT COUNT(*) FROM errors) // 10, 1) AS size FROM errors GROUP BY 1)
            SELECT CAST(ends.h AS INTEGER) AS horizon_days, ROUND(AVG(e), 9) AS mape FROM ends
            JOIN errors ON place <= last AND place > last - size WHERE last >= size GROUP BY 1"""
        ),
    ),
    Entry("m4_walk_forward_cv", _cv),
    Entry("m4_mean_mape", lambda s, f: forecast.mean_mape(_cv(s, f))),
    Entry("m5_retrain_and_append", _retrain),
    Entry(
        "m3_daily_totals",
        lambda s, f: forecast.daily_totals(Tables(s, f).sales, by=["store_id"]),
        with_tables(
            "SELECT store_id, order_date_id AS ds, CAST(SUM(quantity) AS DOUBLE) AS y FROM fact_sales GROUP BY 1, 2",
            "fact_sales",
        ),
    ),
]
