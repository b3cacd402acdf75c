"""Calendar tables: number series, date spines, date dimension, 4-5-4 fiscal calendar.

Ranges come either from literals or from ``bounds``, a one-row frame with the columns
``start`` and ``end``; the latter stays lazy, so a spine over a fact's own range costs one
MIN/MAX scan and never visits the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions import dates as d


def generate_series(spark: SparkSession, upper: int) -> DataFrame:
    """The integers 1 to ``upper``."""
    if upper <= 0:
        raise ValueError("upper must be greater than zero")
    return spark.range(1, upper + 1).withColumnRenamed("id", "generated_number")


def literal_bounds(spark: SparkSession, start, end) -> DataFrame:
    """A bounds row from two dates, datetimes or texts."""
    return spark.range(1).select(
        F.lit(str(start)).cast(d.NTZ).alias("start"), F.lit(str(end)).cast(d.NTZ).alias("end")
    )


def data_bounds(df: DataFrame, column: str | Column) -> DataFrame:
    """Earliest and latest moment of a column as a bounds row."""
    value = (F.col(column) if isinstance(column, str) else column).cast(d.NTZ)
    return df.agg(F.min(value).alias("start"), F.max(value).alias("end"))


def intervals_between(bounds: DataFrame, part: str) -> DataFrame:
    """Number of period boundaries between the bounds."""
    return bounds.select(d.datediff("start", "end", part).alias("intervals"))


def date_spine(
    spark: SparkSession | None,
    part: str,
    start=None,
    end=None,
    bounds: DataFrame | None = None,
    name: str | None = None,
) -> DataFrame:
    """Moments start, start + 1 part, ... with the end excluded; an empty range is an error."""
    if bounds is None:
        bounds = literal_bounds(spark, start, end)
    n = d.datediff("start", "end", part)
    checked = F.when(n > 0, n).otherwise(
        F.raise_error(F.lit("a date spine needs an end after its start")).cast("bigint")
    )
    steps = bounds.select("start", F.explode(F.sequence(F.lit(0).cast("bigint"), checked - 1)).alias("step"))
    return steps.select(d.add_parts(part, F.col("step"), "start").alias(name or f"date_{part}"))


def day_sequence(
    spark: SparkSession | None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    bounds: DataFrame | None = None,
    name: str = "date_day",
) -> DataFrame:
    """Days from start to end, the end included."""
    if bounds is None:
        bounds = literal_bounds(spark, start, end)
    days = F.sequence(F.col("start").cast("date"), F.col("end").cast("date"))
    return bounds.select(F.explode(days).alias(name))


def base_dates(
    spark: SparkSession | None,
    start=None,
    end=None,
    n_dateparts: int | None = None,
    part: str = "day",
    tz: str = "UTC",
    as_of: Column | None = None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """A spine between two moments, or from ``n_dateparts`` back up to the end of today.

    In the second form ``bounds`` may carry an ``as_of`` column instead of a start and end.
    """
    if n_dateparts is not None:
        source = spark.range(1) if bounds is None else bounds
        bounds = source.select(
            d.add_parts(part, -n_dateparts, d.today(tz, as_of)).alias("start"),
            d.tomorrow(tz=tz, as_of=as_of).cast(d.NTZ).alias("end"),
        )
    return date_spine(spark, part, start, end, bounds)


def date_dimension(
    spark: SparkSession | None, start=None, end=None, bounds: DataFrame | None = None
) -> DataFrame:
    """One row per day with 36 calendar attributes; the end is excluded."""
    day = F.col("date_day")
    prior, prior_364 = F.col("prior_year_date_day"), F.col("prior_year_over_year_date_day")
    days = base_dates(spark, start, end, bounds=bounds).select(day.cast("date").alias("date_day"))
    days = days.select(
        "date_day",
        d.prior_year(day).alias("prior_year_date_day"),
        d.prior_year_over_year(day).alias("prior_year_over_year_date_day"),
    )
    return days.select(
        day,
        d.yesterday(day).alias("prior_date_day"),
        d.tomorrow(day).alias("next_date_day"),
        prior,
        prior_364,
        d.day_of_week(day, isoweek=False).alias("day_of_week"),
        d.day_of_week(day, isoweek=True).alias("day_of_week_iso"),
        d.day_name(day, short=False).alias("day_of_week_name"),
        d.day_name(day, short=True).alias("day_of_week_name_short"),
        d.day_of_month(day).alias("day_of_month"),
        d.day_of_year(day).alias("day_of_year"),
        d.week_start(day).alias("week_start_date"),
        d.week_end(day).alias("week_end_date"),
        d.week_start(prior_364).alias("prior_year_week_start_date"),
        d.week_end(prior_364).alias("prior_year_week_end_date"),
        d.week_of_year(day).alias("week_of_year"),
        d.iso_week_start(day).alias("iso_week_start_date"),
        d.iso_week_end(day).alias("iso_week_end_date"),
        d.iso_week_start(prior_364).alias("prior_year_iso_week_start_date"),
        d.iso_week_end(prior_364).alias("prior_year_iso_week_end_date"),
        d.iso_week_of_year(day).alias("iso_week_of_year"),
        d.week_of_year(prior_364).alias("prior_year_week_of_year"),
        d.iso_week_of_year(prior_364).alias("prior_year_iso_week_of_year"),
        F.month(day).alias("month_of_year"),
        d.month_name(day, short=False).alias("month_name"),
        d.month_name(day, short=True).alias("month_name_short"),
        d.period_start("month", day).alias("month_start_date"),
        d.period_end("month", day).alias("month_end_date"),
        d.period_start("month", prior).alias("prior_year_month_start_date"),
        d.period_end("month", prior).alias("prior_year_month_end_date"),
        F.quarter(day).alias("quarter_of_year"),
        d.period_start("quarter", day).alias("quarter_start_date"),
        d.period_end("quarter", day).alias("quarter_end_date"),
        F.year(day).alias("year_number"),
        d.period_start("year", day).alias("year_start_date"),
        d.period_end("year", day).alias("year_end_date"),
    )


def fiscal_year_dates(
    dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """Every day of every complete fiscal year, with its fiscal week.

    A fiscal year ends with the week whose end lies closest to the end of the given month.
    The first year found has no known start and is dropped. ``dates`` is a
    :func:`date_dimension`: one row per day, so the windows below see a few weeks per year.
    The interval lookups are written as equality joins: a day finds its week by arithmetic,
    and each year's range is unfolded into its days.
    """
    weeks = dates.filter(F.col("day_of_week") == week_start_day).select(
        "year_number",
        "month_of_year",
        F.col("date_day").alias("week_start_date"),
        F.date_add("date_day", 6).alias("week_end_date"),
    )
    in_end_month = F.col("month_of_year") == year_end_month
    fiscal_year = (F.col("year_number") - shift_year).alias("fiscal_year_number")
    month_ends = dates.filter(in_end_month).select(fiscal_year, "month_end_date").distinct()
    week_ends = weeks.filter(in_end_month).select(fiscal_year, "week_end_date").distinct()

    closeness = F.abs(F.datediff("month_end_date", "week_end_date"))
    by_year = Window.partitionBy("fiscal_year_number").orderBy(closeness)
    year_ends = (
        week_ends.join(month_ends, "fiscal_year_number")
        .withColumn("closest", F.rank().over(by_year))
        .filter(F.col("closest") == 1)
    )
    # One row per fiscal year: a single ordered window over a few dozen rows.
    previous_end = F.lag("week_end_date").over(Window.orderBy("week_end_date"))
    ranges = year_ends.select(
        "fiscal_year_number",
        F.date_add(previous_end, 1).alias("fiscal_year_start_date"),
        F.col("week_end_date").alias("fiscal_year_end_date"),
    ).filter(F.col("fiscal_year_start_date") <= F.col("fiscal_year_end_date"))
    year_days = ranges.withColumn(
        "date_day", F.explode(F.sequence("fiscal_year_start_date", "fiscal_year_end_date"))
    )

    into_week = F.pmod(F.col("day_of_week") - week_start_day, F.lit(7)).cast("int")
    day_weeks = dates.select("date_day", F.date_sub("date_day", into_week).alias("week_start_date"))
    week_number = F.dense_rank().over(Window.partitionBy("fiscal_year_number").orderBy("week_start_date"))
    return (
        day_weeks.join(year_days, "date_day")
        .join(weeks.select("week_start_date", "week_end_date"), "week_start_date")
        .select(
            "date_day",
            "fiscal_year_number",
            "fiscal_year_start_date",
            "fiscal_year_end_date",
            "week_start_date",
            "week_end_date",
            week_number.alias("fiscal_week_of_year"),
        )
    )


def fiscal_periods(
    dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """Fiscal weeks grouped 4-5-4 into periods and 13 by 13 into quarters.

    Week 53 joins the last period. ``fiscal_week_of_period`` ranks the weeks of a period
    number over all years.
    """
    week = F.col("fiscal_week_of_year")
    in_quarter = (week - 1) % 13
    quarter = F.least(F.floor((week - 1) / 13), F.lit(3)).cast("int")
    period = (
        F.when((week == 53) | (in_quarter >= 9), 3).when(in_quarter >= 4, 2).otherwise(1)
    )
    by_period = Window.partitionBy("fiscal_period_number").orderBy("fiscal_week_of_year")
    return (
        fiscal_year_dates(dates, year_end_month, week_start_day, shift_year)
        .withColumns({"quarter": quarter, "fiscal_period_of_quarter": period})
        .withColumn("fiscal_period_number", F.col("quarter") * 3 + F.col("fiscal_period_of_quarter"))
        .select(
            "date_day",
            "fiscal_year_number",
            "week_start_date",
            "week_end_date",
            "fiscal_week_of_year",
            F.dense_rank().over(by_period).alias("fiscal_week_of_period"),
            "fiscal_period_number",
            (F.col("quarter") + 1).alias("fiscal_quarter_number"),
            "fiscal_period_of_quarter",
        )
    )


def dim_date_fiscal(dates: DataFrame, **fiscal) -> DataFrame:
    """The date dimension with fiscal attributes where a day has them."""
    extra = fiscal_periods(dates, **fiscal).select(
        "date_day",
        "fiscal_week_of_year",
        "fiscal_week_of_period",
        "fiscal_period_number",
        "fiscal_quarter_number",
        "fiscal_period_of_quarter",
    )
    return dates.join(extra, "date_day", "left")


def dim_hour(spark: SparkSession | None = None, **when) -> DataFrame:
    """Hours of the last 28 days up to the end of today."""
    return base_dates(spark, n_dateparts=24 * 28, part="hour", **when)


def dim_week(spark: SparkSession | None = None, **when) -> DataFrame:
    """Week steps of the last 52 weeks up to the end of today."""
    return base_dates(spark, n_dateparts=52, part="week", **when)
