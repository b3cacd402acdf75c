"""Calendar queries. Scalars run over every order date or event time; "now" is a column."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.entry import Entry
from larder.catalog.tables import Tables
from larder.functions import dates as d
from larder.operators import calendar as c

_BOUNDS_SQL = "(SELECT MIN(o_orderdate) AS s, MAX(o_orderdate) AS e FROM orders)"



def _events(columns):
    """A projection of the events; columns are made when it runs, as they need a session."""
    return lambda spark, sf: Tables(spark, sf).raw("events").select(
        "event_id", *(v.alias(k) for k, v in columns().items())
    )


def _orders(columns):
    """The same over the orders."""
    return lambda spark, sf: Tables(spark, sf).raw("orders").select(
        "o_orderkey", *(v.alias(k) for k, v in columns().items())
    )


def _events_sql(**columns):
    return "SELECT event_id, " + ", ".join(f"{v} AS {k}" for k, v in columns.items()) + " FROM events"


def _orders_sql(**columns):
    return "SELECT o_orderkey, " + ", ".join(f"{v} AS {k}" for k, v in columns.items()) + " FROM orders"


def order_bounds(spark, sf):
    return c.data_bounds(Tables(spark, sf).raw("orders"), "o_orderdate")


def _dates(spark, sf):
    return c.date_dimension(None, bounds=order_bounds(spark, sf))


def _latest(spark, sf):
    return Tables(spark, sf).raw("events").agg(F.max("ts").alias("as_of"))


def _series(spark, sf):
    """As many numbers as the orders span days."""
    spine = c.date_spine(None, "day", bounds=order_bounds(spark, sf))
    n = spine.count()
    return c.generate_series(spark, n)


def _fact_datediff(spark, sf):
    joined = Tables(spark, sf).raw("lineitem").join(
        Tables(spark, sf).raw("orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    event = F.timestamp_add("MINUTE", F.col("l_partkey").cast("int"), F.col("l_shipdate"))
    parts = [*d.DATE_PARTS, *d.TIME_PARTS]
    return joined.select(
        "l_orderkey", "l_linenumber", *(d.datediff("o_orderdate", event, p).alias(f"diff_{p}") for p in parts)
    )


_DATEDIFF_SQL = (
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        f"date_diff('{p}', o_orderdate, l_shipdate + to_minutes(l_partkey)) AS diff_{p}"
        for p in [*d.DATE_PARTS, *d.TIME_PARTS]
    )
    + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
)


def _week_start(x: str) -> str:
    return f"CAST(DATE_TRUNC('week', {x} + INTERVAL 1 DAY) - INTERVAL 1 DAY AS DATE)"


def _day(x: str) -> str:
    return f"CAST({x} AS DATE)"


_SPINE = "CAST(UNNEST(generate_series(s, e - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE)"

DATE_DIMENSION_SQL = f"""
SELECT date_day, CAST(date_day - INTERVAL 1 DAY AS DATE) AS prior_date_day,
  CAST(date_day + INTERVAL 1 DAY AS DATE) AS next_date_day, py AS prior_year_date_day, p364 AS prior_year_over_year_date_day,
  dayofweek(date_day) + 1 AS day_of_week, isodow(date_day) AS day_of_week_iso,
  dayname(date_day) AS day_of_week_name, substr(dayname(date_day), 1, 3) AS day_of_week_name_short,
  day(date_day) AS day_of_month, dayofyear(date_day) AS day_of_year,
  {_week_start('date_day')} AS week_start_date, {_week_start('date_day')} + 6 AS week_end_date,
  {_week_start('p364')} AS prior_year_week_start_date, {_week_start('p364')} + 6 AS prior_year_week_end_date,
  CAST(CEIL(dayofyear(date_day) / 7) AS INT) AS week_of_year,
  {_day("DATE_TRUNC('week', date_day)")} AS iso_week_start_date,
  {_day("DATE_TRUNC('week', date_day)")} + 6 AS iso_week_end_date,
  {_day("DATE_TRUNC('week', p364)")} AS prior_year_iso_week_start_date,
  {_day("DATE_TRUNC('week', p364)")} + 6 AS prior_year_iso_week_end_date,
  CAST(week(date_day) AS INT) AS iso_week_of_year, CAST(CEIL(dayofyear(p364) / 7) AS INT) AS prior_year_week_of_year,
  CAST(week(p364) AS INT) AS prior_year_iso_week_of_year, CAST(month(date_day) AS INT) AS month_of_year, monthname(date_day) AS month_name,
  substr(monthname(date_day), 1, 3) AS month_name_short,
  {_day("DATE_TRUNC('month', date_day)")} AS month_start_date, last_day(date_day) AS month_end_date,
  {_day("DATE_TRUNC('month', py)")} AS prior_year_month_start_date, last_day(py) AS prior_year_month_end_date,
  CAST(quarter(date_day) AS INT) AS quarter_of_year, {_day("DATE_TRUNC('quarter', date_day)")} AS quarter_start_date,
  {_day("DATE_TRUNC('quarter', date_day) + INTERVAL 3 MONTH - INTERVAL 1 DAY")} AS quarter_end_date,
  CAST(year(date_day) AS INT) AS year_number, {_day("DATE_TRUNC('year', date_day)")} AS year_start_date,
  {_day("DATE_TRUNC('year', date_day) + INTERVAL 1 YEAR - INTERVAL 1 DAY")} AS year_end_date
FROM (SELECT date_day, CAST(date_day - INTERVAL 1 YEAR AS DATE) AS py, CAST(date_day - INTERVAL 364 DAY AS DATE) AS p364
      FROM (SELECT {_SPINE} AS date_day FROM {_BOUNDS_SQL}))"""

# A year ends on the Saturday nearest to the last day of January, which is the last one up to 3 February. Weeks are
# counted in sevens from the day after the previous end, and a week's period follows from the weeks that periods begin with.
_PERIOD_STARTS = [1 + 13 * quarter + week for quarter in range(4) for week in (0, 4, 9)]
_FISCAL_YEAR = f"""
  ends AS (SELECT y - 1 AS fy, f - CAST((dayofweek(f) + 1) % 7 AS INT) AS e
    FROM (SELECT DISTINCT year_number AS y, make_date(year_number, 2, 3) AS f FROM dates WHERE month_of_year = 1)),
  fiscal AS (SELECT date_day, this.fy AS fiscal_year_number, prev.e + 1 AS fiscal_year_start_date, this.e AS fiscal_year_end_date,
      date_day - CAST(dayofweek(date_day) AS INT) AS week_start_date, date_day - CAST(dayofweek(date_day) AS INT) + 6 AS week_end_date,
      CAST((date_day - prev.e - 1) // 7 + 1 AS INT) AS fiscal_week_of_year
    FROM ends this JOIN ends prev ON prev.fy = this.fy - 1 JOIN dates ON date_day > prev.e AND date_day <= this.e),
  rule AS (SELECT w, CAST(len(list_filter({_PERIOD_STARTS}, lambda x: x <= w)) AS INT) AS period FROM (SELECT UNNEST(range(1, 54)) AS w)),
  periods AS (SELECT date_day, fiscal_year_number, week_start_date, week_end_date, fiscal_week_of_year,
      CAST(w - {_PERIOD_STARTS}[period] + 1 AS INT) AS fiscal_week_of_period, period AS fiscal_period_number,
      (period - 1) // 3 + 1 AS fiscal_quarter_number, (period - 1) % 3 + 1 AS fiscal_period_of_quarter
    FROM fiscal JOIN rule ON w = fiscal_week_of_year)"""


def _fiscal_sql(body: str) -> str:
    return f"WITH dates AS ({DATE_DIMENSION_SQL}), {_FISCAL_YEAR} {body}"


FISCAL = {"year_end_month": 1, "week_start_day": 1, "shift_year": 1}


def _spine_sql(part: str) -> str:
    return (
        f"SELECT s + CAST(i AS INT) * INTERVAL 1 {part} AS date_{part} FROM (SELECT s, e, "
        f"UNNEST(range(date_diff('{part}', s, e))) AS i FROM {_BOUNDS_SQL})"
    )


def _back_sql(n: int, part: str) -> str:
    """A spine from n parts before the last event's day to the day's end."""
    return (
        f"SELECT b + CAST(i AS INT) * INTERVAL 1 {part} AS date_{part} FROM (SELECT b, "
        f"UNNEST(range(date_diff('{part}', b, t + INTERVAL 1 DAY))) AS i FROM (SELECT t - INTERVAL {n} {part} AS b, t "
        f"FROM (SELECT DATE_TRUNC('day', MAX(ts))::TIMESTAMP AS t FROM events)))"
    )


_LA = "America/Los_Angeles"
_LA_TS = f"ts AT TIME ZONE 'UTC' AT TIME ZONE '{_LA}'"
_LA_DAY = f"CAST({_LA_TS} AS DATE)"


def _now() -> dict:
    return {"tz": _LA, "as_of": F.col("ts")}



ENTRIES = [
    Entry("d0_datediff", _fact_datediff, _DATEDIFF_SQL),
    Entry(
        "d1_generate_series",
        _series,
        f"SELECT UNNEST(range(1, date_diff('day', s, e) + 1)) AS generated_number FROM {_BOUNDS_SQL}",
    ),
    Entry(
        "d1b_intervals_between",
        lambda s, f: c.intervals_between(order_bounds(s, f), "week"),
        f"SELECT date_diff('week', s, e) AS intervals FROM {_BOUNDS_SQL}",
    ),
    Entry("d2_date_spine_day", lambda s, f: c.date_spine(None, "day", bounds=order_bounds(s, f)), _spine_sql("day")),
    Entry(
        "d2_date_spine_month", lambda s, f: c.date_spine(None, "month", bounds=order_bounds(s, f)), _spine_sql("month")
    ),
    Entry("d2_date_spine_hour", lambda s, f: c.date_spine(None, "hour", bounds=order_bounds(s, f)), _spine_sql("hour")),
    Entry("d2b_base_dates", lambda s, f: c.base_dates(None, bounds=order_bounds(s, f)), _spine_sql("day")),
    Entry(
        "d2b_base_dates_back",
        lambda s, f: c.base_dates(None, n_dateparts=30, part="day", as_of=F.col("as_of"), bounds=_latest(s, f)),
        _back_sql(30, "day"),
    ),
    Entry("d3_date_dimension", _dates, DATE_DIMENSION_SQL),
    Entry(
        "d4_fiscal_year_dates",
        lambda s, f: c.fiscal_year_dates(_dates(s, f), **FISCAL),
        _fiscal_sql("SELECT * FROM fiscal"),
    ),
    Entry(
        "d5_fiscal_periods",
        lambda s, f: c.fiscal_periods(_dates(s, f), **FISCAL),
        _fiscal_sql("SELECT * FROM periods"),
    ),
    Entry(
        "d6_dim_date_fiscal",
        lambda s, f: c.dim_date_fiscal(_dates(s, f), **FISCAL),
        _fiscal_sql(
            "SELECT d.*, f.fiscal_week_of_year, f.fiscal_week_of_period, f.fiscal_period_number, "
            "f.fiscal_quarter_number, f.fiscal_period_of_quarter FROM dates d LEFT JOIN periods f ON d.date_day = f.date_day"
        ),
    ),
    Entry(
        "d7_dim_hour",
        lambda s, f: c.dim_hour(as_of=F.col("as_of"), bounds=_latest(s, f)),
        _back_sql(24 * 28, "hour"),
    ),
    Entry(
        "d7_dim_week",
        lambda s, f: c.dim_week(as_of=F.col("as_of"), bounds=_latest(s, f)),
        _back_sql(52, "week"),
    ),
    Entry(
        "d10_convert_timezone",
        _events(lambda: dict(la=d.convert_timezone(F.col("ts"), _LA), back=d.convert_timezone(F.col("ts"), "UTC", "Asia/Jakarta"))),
        _events_sql(la=_LA_TS, back="ts AT TIME ZONE 'Asia/Jakarta' AT TIME ZONE 'UTC'"),
    ),
    Entry(
        "d11_date_part",
        _events(lambda: dict(**{f"part_{p}": d.date_part(p, F.col("ts")) for p in ("year", "month", "day", "hour", "minute", "dow", "doy", "week")})),
        _events_sql(**{f"part_{p}": f"date_part('{p}', ts)" for p in ("year", "month", "day", "hour", "minute", "dow", "doy", "week")}),
    ),
    Entry(
        "d12_day_name",
        _orders(lambda: dict(long_name=d.day_name(F.col("o_orderdate"), short=False), short_name=d.day_name(F.col("o_orderdate")))),
        _orders_sql(long_name="dayname(o_orderdate)", short_name="substr(dayname(o_orderdate), 1, 3)"),
    ),
    Entry(
        "d13_month_name",
        _orders(lambda: dict(long_name=d.month_name(F.col("o_orderdate"), short=False), short_name=d.month_name(F.col("o_orderdate")))),
        _orders_sql(long_name="monthname(o_orderdate)", short_name="substr(monthname(o_orderdate), 1, 3)"),
    ),
    Entry("d14_day_of_month", _orders(lambda: dict(day=d.day_of_month(F.col("o_orderdate")))), _orders_sql(day="day(o_orderdate)")),
    Entry(
        "d15_day_of_week",
        _orders(lambda: dict(iso=d.day_of_week(F.col("o_orderdate")), us=d.day_of_week(F.col("o_orderdate"), isoweek=False))),
        _orders_sql(iso="isodow(o_orderdate)", us="dayofweek(o_orderdate) + 1"),
    ),
    Entry("d16_day_of_year", _orders(lambda: dict(day=d.day_of_year(F.col("o_orderdate")))), _orders_sql(day="dayofyear(o_orderdate)")),
    Entry(
        "d17_from_unixtimestamp",
        _orders(lambda: dict(
            seconds=d.from_unixtimestamp(F.lit(1623076520) + F.col("o_orderkey")),
            millis=d.from_unixtimestamp(F.lit(1623076520123) + F.col("o_orderkey"), "milliseconds"),
            micros=d.from_unixtimestamp(F.lit(1623076520123456) + F.col("o_orderkey"), "microseconds"),
        )),
        _orders_sql(
            seconds="make_timestamp((1623076520 + o_orderkey) * 1000000)",
            millis="make_timestamp((1623076520123 + o_orderkey) * 1000)",
            micros="make_timestamp(1623076520123456 + o_orderkey)",
        ),
    ),
    Entry("d18_to_unixtimestamp", _events(lambda: dict(epoch=d.to_unixtimestamp(F.col("ts")))), _events_sql(epoch="epoch(ts)")),
    Entry("d19_iso_week_start", _orders(lambda: dict(day=d.iso_week_start(F.col("o_orderdate")))), _orders_sql(day=_day("DATE_TRUNC('week', o_orderdate)"))),
    Entry("d20_iso_week_end", _orders(lambda: dict(day=d.iso_week_end(F.col("o_orderdate")))), _orders_sql(day=_day("DATE_TRUNC('week', o_orderdate)") + " + 6")),
    Entry("d21_iso_week_of_year", _orders(lambda: dict(week=d.iso_week_of_year(F.col("o_orderdate")))), _orders_sql(week="CAST(week(o_orderdate) AS INT)")),
    Entry("d22_week_start", _orders(lambda: dict(day=d.week_start(F.col("o_orderdate")))), _orders_sql(day=_week_start("o_orderdate"))),
    Entry("d23_week_end", _orders(lambda: dict(day=d.week_end(F.col("o_orderdate")))), _orders_sql(day=_week_start("o_orderdate") + " + 6")),
    Entry(
        "d24_week_of_year",
        _orders(lambda: dict(week=d.week_of_year(F.col("o_orderdate")))),
        _orders_sql(week="CAST(CEIL(dayofyear(o_orderdate) / 7) AS INT)"),
    ),
    Entry("d25_now", _events(lambda: dict(now=d.now(**_now()))), _events_sql(now=_LA_TS)),
    Entry("d26_today", _events(lambda: dict(today=d.today(**_now()))), _events_sql(today=_LA_DAY)),
    Entry(
        "d27_yesterday_tomorrow",
        _events(lambda: dict(y=d.yesterday(**_now()), t=d.tomorrow(**_now()), before=d.yesterday(F.col("ts")), after=d.tomorrow(F.col("ts")))),
        _events_sql(y=f"{_LA_DAY} - 1", t=f"{_LA_DAY} + 1", before="CAST(ts AS DATE) - 1", after="CAST(ts AS DATE) + 1"),
    ),
    Entry(
        "d28_n_days",
        _events(lambda: dict(ago=d.n_days_ago(10, **_now()), away=d.n_days_away(10, **_now()))),
        _events_sql(ago=f"{_LA_DAY} - 10", away=f"{_LA_DAY} + 10"),
    ),
    Entry(
        "d29_n_weeks",
        _events(lambda: dict(ago=d.n_weeks_ago(3, **_now()), away=d.n_weeks_away(3, **_now()))),
        _events_sql(
            ago=_day(f"DATE_TRUNC('week', {_LA_DAY} - INTERVAL 3 WEEK)"),
            away=_day(f"DATE_TRUNC('week', {_LA_DAY} + INTERVAL 3 WEEK)"),
        ),
    ),
    Entry(
        "d30_n_months",
        _events(lambda: dict(ago=d.n_months_ago(3, **_now()), away=d.n_months_away(3, **_now()))),
        _events_sql(
            ago=_day(f"DATE_TRUNC('month', {_LA_DAY} - INTERVAL 3 MONTH)"),
            away=_day(f"DATE_TRUNC('month', {_LA_DAY} + INTERVAL 3 MONTH)"),
        ),
    ),
    Entry(
        "d31_last_next_week",
        _events(lambda: dict(last=d.last_week(**_now()), following=d.next_week(**_now()))),
        _events_sql(
            last=_day(f"DATE_TRUNC('week', {_LA_DAY} - INTERVAL 1 WEEK)"),
            following=_day(f"DATE_TRUNC('week', {_LA_DAY} + INTERVAL 1 WEEK)"),
        ),
    ),
    Entry(
        "d32_last_next_month",
        _events(lambda: dict(last=d.last_month(**_now()), following=d.next_month(**_now()))),
        _events_sql(
            last=_day(f"DATE_TRUNC('month', {_LA_DAY} - INTERVAL 1 MONTH)"),
            following=_day(f"DATE_TRUNC('month', {_LA_DAY} + INTERVAL 1 MONTH)"),
        ),
    ),
    Entry(
        "d33_last_next_month_name",
        _events(lambda: dict(last=d.last_month_name(**_now()), following=d.next_month_name(short=False, **_now()))),
        _events_sql(
            last=f"substr(monthname({_LA_DAY} - INTERVAL 1 MONTH), 1, 3)",
            following=f"monthname({_LA_DAY} + INTERVAL 1 MONTH)",
        ),
    ),
    Entry(
        "d34_last_next_month_number",
        _events(lambda: dict(last=d.last_month_number(**_now()), following=d.next_month_number(**_now()))),
        _events_sql(last=f"month({_LA_DAY} - INTERVAL 1 MONTH)", following=f"month({_LA_DAY} + INTERVAL 1 MONTH)"),
    ),
    Entry(
        "d35_periods_since",
        _events(lambda: dict(
            **{
                f"since_{p}": d.periods_since(F.lit("2020-02-29 23:30:00").cast("timestamp_ntz"), p, as_of=F.col("ts"))
                for p in ("day", "week", "month", "year")
            }
        )),
        _events_sql(
            **{
                f"since_{p}": f"date_diff('{p}', TIMESTAMP '2020-02-29 23:30:00', ts)"
                for p in ("day", "week", "month", "year")
            }
        ),
    ),
    Entry(
        "d36_round_timestamp",
        _events(lambda: dict(day=d.round_timestamp(F.col("ts")))),
        _events_sql(day="CAST(DATE_TRUNC('day', ts + INTERVAL 12 HOUR) AS TIMESTAMP)"),
    ),
    Entry(
        "d37_date_datetime",
        _events(lambda: dict(
            day=d.make_date(F.year(F.col("ts")), F.month(F.col("ts")), F.day(F.col("ts"))),
            moment=d.make_datetime(F.year(F.col("ts")), F.month(F.col("ts")), F.day(F.col("ts")), F.hour(F.col("ts")), F.minute(F.col("ts")), tz=_LA),
        )),
        _events_sql(
            day="make_date(year(ts), month(ts), day(ts))",
            moment="make_timestamp(year(ts), month(ts), day(ts), hour(ts), minute(ts), 0.0) "
            f"AT TIME ZONE '{_LA}' AT TIME ZONE 'UTC'",
        ),
    ),
    Entry(
        "d38_period_bounds",
        _orders(lambda: dict(
            **{f"{p}_start": d.period_start(p, F.col("o_orderdate")) for p in ("month", "quarter", "year")},
            **{f"{p}_end": d.period_end(p, F.col("o_orderdate")) for p in ("month", "quarter", "year")},
        )),
        _orders_sql(
            **{f"{p}_start": _day(f"DATE_TRUNC('{p}', o_orderdate)") for p in ("month", "quarter", "year")},
            **{
                f"{p}_end": _day(f"DATE_TRUNC('{p}', o_orderdate) + INTERVAL {n} MONTH - INTERVAL 1 DAY")
                for p, n in (("month", 1), ("quarter", 3), ("year", 12))
            },
        ),
    ),
    Entry(
        "d39_prior_year_dates",
        _orders(lambda: dict(prior=d.prior_year(F.col("o_orderdate")), prior_364=d.prior_year_over_year(F.col("o_orderdate")))),
        _orders_sql(prior=_day("o_orderdate - INTERVAL 1 YEAR"), prior_364=_day("o_orderdate - INTERVAL 364 DAY")),
    ),
]
