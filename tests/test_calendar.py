"""Calendar functions on known dates."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.functions import dates as d
from larder.operators import calendar as c
from larder.operators.silver import dim_date

D = dt.date


@pytest.fixture(scope="module")
def golden(spark):
    rows = [(D(2020, 11, 29),), (D(2020, 12, 1),)]
    return spark.createDataFrame(rows, "day date")


@pytest.mark.parametrize(
    "make, want",
    [
        (lambda x: d.yesterday(x), [D(2020, 11, 28), D(2020, 11, 30)]),
        (lambda x: d.tomorrow(x), [D(2020, 11, 30), D(2020, 12, 2)]),
        (lambda x: d.day_name(x, short=False), ["Sunday", "Tuesday"]),
        (lambda x: d.day_name(x), ["Sun", "Tue"]),
        (lambda x: d.day_of_month(x), [29, 1]),
        (lambda x: d.day_of_week(x, isoweek=False), [1, 3]),
        (lambda x: d.day_of_week(x), [7, 2]),
        (lambda x: d.day_of_year(x), [334, 336]),
        (lambda x: d.week_start(x), [D(2020, 11, 29), D(2020, 11, 29)]),
        (lambda x: d.week_end(x), [D(2020, 12, 5), D(2020, 12, 5)]),
        (lambda x: d.week_of_year(x), [48, 48]),
        (lambda x: d.iso_week_start(x), [D(2020, 11, 23), D(2020, 11, 30)]),
        (lambda x: d.iso_week_end(x), [D(2020, 11, 29), D(2020, 12, 6)]),
        (lambda x: d.iso_week_of_year(x), [48, 49]),
        (lambda x: d.month_name(x, short=False), ["November", "December"]),
        (lambda x: d.month_name(x), ["Nov", "Dec"]),
        (lambda x: d.prior_year(x), [D(2019, 11, 29), D(2019, 12, 1)]),
        (lambda x: d.prior_year_over_year(x), [D(2019, 12, 1), D(2019, 12, 3)]),
        (lambda x: d.period_end("quarter", x), [D(2020, 12, 31)] * 2),
    ],
)
def test_golden_dates(golden, make, want):
    got = golden.orderBy("day").select(make(F.col("day")).alias("v")).collect()
    assert [r.v for r in got] == want


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_epochs_and_zones(spark):
    utc, la = dt.datetime(2021, 6, 7, 14, 35, 20), dt.datetime(2021, 6, 7, 7, 35, 20)
    moment = d.from_unixtimestamp(F.lit(1623076520))
    assert one(spark, moment) == utc
    assert one(spark, d.from_unixtimestamp(F.lit(1623076520000), "milliseconds")) == utc
    assert one(spark, d.from_unixtimestamp(F.lit(1623076520 * 10**9), "nanoseconds")) == utc
    assert one(spark, d.to_unixtimestamp(moment)) == 1623076520
    assert one(spark, d.convert_timezone(moment, "America/Los_Angeles")) == la
    assert one(spark, d.round_timestamp(moment)) == dt.datetime(2021, 6, 8)
    assert one(spark, d.round_timestamp(d.convert_timezone(moment, "America/Los_Angeles"))) == dt.datetime(2021, 6, 7)
    assert one(spark, d.make_datetime(2021, 6, 7, 7, 35, 20, tz="America/Los_Angeles")) == utc
    assert one(spark, d.make_date(2020, 2, 29)) == D(2020, 2, 29)
    with pytest.raises(ValueError):
        d.from_unixtimestamp(F.lit(1), "hours")


@pytest.mark.parametrize(
    "start, end, part, want",
    [
        ("2020-01-31 00:00:00", "2020-02-01 00:00:00", "month", 1),
        ("2020-01-01 23:00:00", "2020-01-02 01:00:00", "day", 1),
        ("2020-01-01 00:59:00", "2020-01-01 01:01:00", "hour", 1),
        ("2019-12-31 00:00:00", "2020-01-01 00:00:00", "year", 1),
        ("2019-12-31 00:00:00", "2020-01-01 00:00:00", "quarter", 1),
        ("2020-02-29 23:30:00", "2020-03-08 01:00:00", "week", 1),
        ("2020-03-08 01:00:00", "2020-02-29 23:30:00", "week", -1),
        ("1969-12-31 23:59:59", "1970-01-01 00:00:01", "second", 2),
    ],
)
def test_datediff_counts_boundaries(spark, start, end, part, want):
    assert one(spark, d.datediff(ts(start), ts(end), part)) == want


def test_shift_clamps_step_by_step(spark):
    day = F.lit("2020-02-29").cast("date")
    assert one(spark, d.shift_date(day, 5, 10)) == D(2025, 12, 28)
    assert one(spark, d.shift_date(day, 9)) == D(2029, 2, 28)
    assert one(spark, d.shift_date(ts("2020-02-29 10:00:00"), 5, 10)) == dt.datetime(2025, 12, 28, 10)
    assert one(spark, d.shift_date(day)) == D(2020, 2, 29)


def test_now_is_fixed_by_as_of(spark):
    late = {"tz": "America/Los_Angeles", "as_of": ts("2024-03-01 02:00:00")}
    assert one(spark, d.today(**late)) == D(2024, 2, 29)
    assert one(spark, d.last_month(**late)) == D(2024, 1, 1)
    assert one(spark, d.next_month_name(short=False, **late)) == "March"
    assert one(spark, d.last_week(**late)) == D(2024, 2, 19)
    assert abs((one(spark, d.now()) - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 60
    with pytest.raises(ValueError):
        d.trunc_to("fortnight", "x")


def test_spines(spark):
    days = c.date_spine(spark, "day", "2020-02-27", "2020-03-01").orderBy("date_day").collect()
    assert [r.date_day.day for r in days] == [27, 28, 29]
    months = c.date_spine(spark, "month", "2020-01-31", "2020-05-01").orderBy("date_month").collect()
    assert [r.date_month.date() for r in months] == [D(2020, 1, 31), D(2020, 2, 29), D(2020, 3, 31), D(2020, 4, 30)]
    with pytest.raises(Exception, match="end after its start"):
        c.date_spine(spark, "day", "2020-01-01", "2020-01-01").collect()
    with pytest.raises(ValueError):
        c.generate_series(spark, 0)
    assert [r[0] for r in c.generate_series(spark, 4).collect()] == [1, 2, 3, 4]
    now = ts("2024-01-10 05:00:00")
    assert c.dim_hour(spark, as_of=now).count() == 24 * 28 + 24
    assert c.base_dates(spark, n_dateparts=3, as_of=now).count() == 4
    assert c.dim_week(spark, as_of=now).count() == 52


def test_dim_date(spark):
    days = dim_date(spark)
    assert days.count() == 7670
    first = days.filter("date_id = DATE '2012-02-29'").first()
    assert (first.day_of_week_num, first.day_name, first.quarter) == (3, "Wednesday", 1)


def test_fiscal_years(spark):
    dates = c.date_dimension(spark, "2015-01-01", "2022-12-31")
    assert (dates.count(), len(dates.columns)) == (2921, 36)
    years = c.fiscal_year_dates(dates, year_end_month=1, week_start_day=1, shift_year=1)
    assert years.count() == 2555
    got = years.groupBy("fiscal_year_number").agg(
        F.min("date_day").alias("a"), F.max("date_day").alias("b"), F.max("fiscal_week_of_year").alias("w")
    )
    assert [tuple(r) for r in got.orderBy("fiscal_year_number").collect()] == [
        (2015, D(2015, 2, 1), D(2016, 1, 30), 52),
        (2016, D(2016, 1, 31), D(2017, 1, 28), 52),
        (2017, D(2017, 1, 29), D(2018, 2, 3), 53),
        (2018, D(2018, 2, 4), D(2019, 2, 2), 52),
        (2019, D(2019, 2, 3), D(2020, 2, 1), 52),
        (2020, D(2020, 2, 2), D(2021, 1, 30), 52),
        (2021, D(2021, 1, 31), D(2022, 1, 29), 52),
    ]
    periods = c.fiscal_periods(dates, 1, 1, 1)
    pick = lambda day: tuple(
        periods.filter(F.col("date_day") == F.lit(day))
        .select("fiscal_week_of_year", "fiscal_period_number", "fiscal_quarter_number", "fiscal_period_of_quarter")
        .first()
    )
    assert pick(D(2018, 2, 3)) == (53, 12, 4, 3)
    assert pick(D(2020, 11, 29)) == (44, 11, 4, 2)
    whole = c.dim_date_fiscal(dates, year_end_month=1)
    assert whole.count() == 2921 and whole.filter("fiscal_period_number is null").count() == 2921 - 2555
