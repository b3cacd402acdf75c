"""Checks of a metric over time and across groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import dates as d
from larder.functions.numbers import log_natural
from larder.operators.calendar import date_spine, literal_bounds
from larder.operators.expectations.core import as_column, where

__all__ = [
    "expect_column_values_to_be_within_n_moving_stdevs",
    "expect_column_values_to_be_within_n_stdevs",
    "expect_row_values_to_have_data_for_every_n_datepart",
]


def expect_column_values_to_be_within_n_moving_stdevs(
    df: DataFrame,
    column: str,
    date_column: str,
    group_by: Sequence[str] | None = None,
    period: str = "day",
    lookback_periods: int = 1,
    trend_periods: int = 7,
    test_periods: int = 14,
    sigma_threshold: float = 3,
    sigma_threshold_upper: float | None = None,
    sigma_threshold_lower: float | None = None,
    take_diffs: bool = True,
    take_logs: bool = True,
    tz: str = "UTC",
    as_of: Column | None = None,
) -> DataFrame:
    """Fails for recent periods whose metric leaves the band of the periods before them.

    The metric is the period's sum (its logarithm, with ``take_logs``), or its change
    against ``lookback_periods`` earlier. It is measured in standard deviations of the
    ``trend_periods`` preceding rows. Tested are the ``test_periods`` periods before the
    current one. Thresholds of 0 mean none given. Windows run over the aggregated periods:
    a group has at most one row per calendar period.
    """
    groups = list(group_by or ())
    upper = sigma_threshold_upper or sigma_threshold
    lower = sigma_threshold_lower or -sigma_threshold
    metric = (lambda c: F.coalesce(log_natural(c), F.lit(0.0))) if take_logs else (lambda c: F.coalesce(c, F.lit(0)))

    sums = df.groupBy(d.trunc_to(period, as_column(date_column)).alias("metric_period"), *groups).agg(
        F.sum(as_column(column)).alias("agg_metric_value")
    )
    in_order = Window.partitionBy(*groups).orderBy(F.asc_nulls_last("metric_period"))
    value = metric(F.col("agg_metric_value"))
    if take_diffs:
        prior = F.lag("agg_metric_value", lookback_periods).over(in_order)
        sums = sums.withColumn("prior_agg_metric_value", prior)
        value = value - metric(F.col("prior_agg_metric_value"))
    before = in_order.rowsBetween(-trend_periods, -1)
    tested = F.col("metric_test_value")
    scored = (
        sums.withColumn("metric_test_value", value)
        .withColumns(
            {
                "metric_test_rolling_average": F.avg(tested).over(before),
                "metric_test_rolling_stddev": F.stddev_samp(tested).over(before),
            }
        )
        .withColumn("metric_test_delta", tested - F.col("metric_test_rolling_average"))
        .withColumn(
            "metric_test_sigma",
            F.col("metric_test_delta") / F.nullif(F.col("metric_test_rolling_stddev"), F.lit(0.0)),
        )
    )
    current = d.trunc_to(period, d.now(tz, as_of))
    sigma, when = F.col("metric_test_sigma"), F.col("metric_period")
    recent = (when >= d.add_parts(period, -test_periods, current)) & (when < current)
    return scored.filter(recent & ~((sigma >= lower) & (sigma <= upper)))


def expect_column_values_to_be_within_n_stdevs(
    df: DataFrame, column: str, group_by: Sequence[str] | None = None, sigma_threshold: float = 3
) -> DataFrame:
    """Fails for each group whose sum lies further than the threshold from the mean of all
    sums. Without groups there is one sum, and nothing to compare it with.

    Mean and deviation are one looked-up row, not a window over all groups.
    """
    groups = list(group_by or ())
    total = F.sum(as_column(column)).alias(column)
    sums = df.groupBy(*groups).agg(total) if groups else df.agg(total)
    value = F.col(column)
    stats = sums.agg(F.struct(F.avg(value).alias("mean"), F.stddev_samp(value).alias("spread")).alias("s")).scalar()
    scored = sums.withColumns(
        {f"{column}_average": stats["mean"], f"{column}_stddev": stats["spread"]}
    ).withColumn(
        f"{column}_sigma",
        (value - F.col(f"{column}_average")) / F.nullif(F.col(f"{column}_stddev"), F.lit(0.0)),
    )
    return scored.filter(F.abs(F.col(f"{column}_sigma")) > sigma_threshold)


def expect_row_values_to_have_data_for_every_n_datepart(
    df: DataFrame,
    date_col: str,
    date_part: str = "day",
    interval: int | None = None,
    row_condition=None,
    exclusion_condition=None,
    test_start_date=None,
    test_end_date=None,
) -> DataFrame:
    """Fails for each period of the range that has no rows.

    The range is the data's own unless given, and its end is not tested. ``interval`` puts
    that many periods, counted from the start, into one bucket. ``exclusion_condition``
    filters the failures.
    """
    rows = where(df, row_condition)
    moment = as_column(date_col)
    name = f"date_{date_part}"
    if test_start_date and test_end_date:
        bounds = literal_bounds(df.sparkSession, test_start_date, test_end_date)
    else:
        day = moment.cast("date").cast(d.NTZ)
        given = lambda x, c: F.lit(str(x)).cast(d.NTZ) if x else c
        bounds = rows.agg(
            given(test_start_date, F.min(day)).alias("start"), given(test_end_date, F.max(day)).alias("end")
        )
    spine = date_spine(None, date_part, bounds=bounds)
    bucket = d.trunc_to(date_part, moment)
    if interval:
        start = bounds.select("start").scalar()
        spine = spine.filter(d.datediff(start, name, date_part) % interval == 0)
        into = d.datediff(start, moment, date_part) % interval
        bucket = d.add_parts(date_part, -into, bucket)
    counts = rows.groupBy(bucket.alias(name)).agg(F.count(F.lit(1)).alias("_rows"))
    result = spine.join(counts, name, "left").select(
        name,
        F.col("_rows").isNull().alias("is_missing"),
        F.coalesce("_rows", F.lit(0).cast("bigint")).alias("row_cnt"),
    )
    return where(result.filter(F.col("row_cnt") == 0), exclusion_condition)
