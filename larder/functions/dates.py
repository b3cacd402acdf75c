"""Calendar columns. All functions map columns to columns and keep wall-clock time.

Timestamps are ``timestamp_ntz`` throughout, so nothing here depends on the session zone.
Functions relative to "now" take ``tz`` and ``as_of`` (a UTC ``timestamp_ntz`` column,
default: the current time), which makes them repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"
DATE_PARTS = ("year", "quarter", "month", "week", "day")
TIME_PARTS = ("hour", "minute", "second")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _check_part(part: str) -> str:
    part = part.lower()
    if part not in DATE_PARTS + TIME_PARTS:
        raise ValueError(f"unknown date part: {part}")
    return part


# --- arithmetic -----------------------------------------------------------------


def trunc_to(part: str, value: Column | str) -> Column:
    """Start of the period, as timestamp without zone. Weeks start on Monday."""
    part, value = _check_part(part), _col(value)
    if part == "day":
        return value.cast("date").cast(NTZ)
    if part in DATE_PARTS:
        return F.trunc(value.cast("date"), part).cast(NTZ)
    ts = value.cast(NTZ)
    zero = F.lit(0)
    return F.make_timestamp_ntz(
        F.year(ts),
        F.month(ts),
        F.day(ts),
        F.hour(ts),
        zero if part == "hour" else F.minute(ts),
        F.second(ts).cast("decimal(8,6)") if part == "second" else zero.cast("decimal(8,6)"),
    )


def add_parts(part: str, n: int | Column, value: Column | str) -> Column:
    """Add ``n`` periods; months, quarters and years clamp to the end of the month."""
    part = _check_part(part)
    n = F.lit(n) if isinstance(n, int) else n
    return F.timestamp_add(part.upper(), n.cast("int"), _col(value).cast(NTZ))


def datediff(start: Column | str, end: Column | str, part: str = "day") -> Column:
    """Number of period boundaries between two moments (Jan 31 to Feb 1 is one month).

    Weeks have no boundary of their own: they are full blocks of seven day boundaries.
    """
    part = _check_part(part)
    a, b = _col(start), _col(end)
    if part == "year":
        return (F.year(b) - F.year(a)).cast("bigint")
    if part == "quarter":
        return ((F.year(b) - F.year(a)) * 4 + F.quarter(b) - F.quarter(a)).cast("bigint")
    if part == "month":
        return ((F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)).cast("bigint")
    days = F.datediff(b.cast("date"), a.cast("date")).cast("bigint")
    if part == "day":
        return days
    if part == "week":
        return (days / 7).cast("bigint")
    a, b = a.cast(NTZ), b.cast(NTZ)
    hours = days * 24 + F.hour(b) - F.hour(a)
    if part == "hour":
        return hours.cast("bigint")
    minutes = hours * 60 + F.minute(b) - F.minute(a)
    if part == "minute":
        return minutes.cast("bigint")
    return (minutes * 60 + F.second(b) - F.second(a)).cast("bigint")


def shift_date(value: Column | str, years: int = 0, months: int = 0) -> Column:
    """Add years, then months; each step clamps to the month end on its own.

    Dates stay dates, timestamps stay timestamps without zone.
    """
    value = _col(value)
    if years:
        value = value + F.make_ym_interval(F.lit(years))
    if months:
        value = value + F.make_ym_interval(F.lit(0), F.lit(months))
    return value


# --- fields ---------------------------------------------------------------------


def date_part(part: str, value: Column | str) -> Column:
    """Extract one field as bigint. Day of week counts from Sunday = 0."""
    part, value = part.lower(), _col(value)
    if part in ("dow", "dayofweek"):
        return (F.dayofweek(value) - 1).cast("bigint")
    if part in ("isodow", "dayofweekiso"):
        return (F.weekday(value) + 1).cast("bigint")
    return F.date_part(F.lit(part), value).cast("bigint")


def day_name(value: Column | str, short: bool = True) -> Column:
    """English day name, or its first three letters."""
    return F.date_format(_col(value), "E" if short else "EEEE")


def month_name(value: Column | str, short: bool = True) -> Column:
    """English month name, or its first three letters."""
    return F.date_format(_col(value), "MMM" if short else "MMMM")


def day_of_month(value: Column | str) -> Column:
    """1 to 31."""
    return F.dayofmonth(_col(value)).cast("bigint")


def day_of_week(value: Column | str, isoweek: bool = True) -> Column:
    """Monday 1 to Sunday 7, or with ``isoweek=False`` Sunday 1 to Saturday 7."""
    value = _col(value)
    return (F.weekday(value) + 1 if isoweek else F.dayofweek(value)).cast("bigint")


def day_of_year(value: Column | str) -> Column:
    """1 to 366."""
    return F.dayofyear(_col(value)).cast("bigint")


def week_of_year(value: Column | str) -> Column:
    """Blocks of seven days counted from January 1st."""
    return F.ceil(F.dayofyear(_col(value)) / 7).cast("int")


def iso_week_of_year(value: Column | str) -> Column:
    """ISO 8601 week number."""
    return F.weekofyear(_col(value)).cast("int")


# --- period starts and ends -----------------------------------------------------


def iso_week_start(value: Column | str) -> Column:
    """Monday of the week."""
    return F.trunc(_col(value).cast("date"), "week")


def iso_week_end(value: Column | str) -> Column:
    """Sunday of the ISO week."""
    return F.date_add(iso_week_start(value), 6)


def week_start(value: Column | str) -> Column:
    """Sunday on or before the date."""
    value = _col(value).cast("date")
    return F.date_sub(value, F.dayofweek(value) - 1)


def week_end(value: Column | str) -> Column:
    """Saturday on or after the date."""
    return F.date_add(week_start(value), 6)


def period_start(part: str, value: Column | str) -> Column:
    """First day of the month, quarter or year."""
    return F.trunc(_col(value).cast("date"), part)


def period_end(part: str, value: Column | str) -> Column:
    """Last day of the month, quarter or year."""
    months = {"month": 1, "quarter": 3, "year": 12}[part]
    return F.date_sub(F.add_months(period_start(part, value), months), 1)


def prior_year(value: Column | str) -> Column:
    """Same calendar day one year earlier (Feb 29 becomes Feb 28)."""
    return F.add_months(_col(value).cast("date"), -12)


def prior_year_over_year(value: Column | str) -> Column:
    """Same weekday one year earlier: 364 days back."""
    return F.date_sub(_col(value).cast("date"), 364)


# --- conversions ----------------------------------------------------------------


def convert_timezone(value: Column | str, target: str, source: str = "UTC") -> Column:
    """Wall-clock time in ``source`` to wall-clock time in ``target``."""
    return F.convert_timezone(F.lit(source), F.lit(target), _col(value).cast(NTZ))


def from_unixtimestamp(epoch: Column | str, fmt: str = "seconds") -> Column:
    """Epoch number to UTC time."""
    scale = {"seconds": 1_000_000, "milliseconds": 1_000, "microseconds": 1, "nanoseconds": None}
    if fmt not in scale:
        raise ValueError(f"value {fmt} for `fmt` is not supported")
    epoch = _col(epoch).cast("bigint")
    micros = F.floor(epoch / 1000).cast("bigint") if scale[fmt] is None else epoch * scale[fmt]
    start = F.lit("1970-01-01 00:00:00").cast(NTZ)
    return F.timestamp_add("MICROSECOND", micros, start)


def to_unixtimestamp(value: Column | str) -> Column:
    """UTC time to epoch seconds, with their fraction."""
    start = F.lit("1970-01-01 00:00:00").cast(NTZ)
    return F.timestamp_diff("MICROSECOND", start, _col(value)) / F.lit(1e6)


def round_timestamp(value: Column | str) -> Column:
    """Nearest midnight: twelve hours later, cut to the day."""
    return trunc_to("day", add_parts("hour", 12, value))


def make_date(year: Column | int, month: Column | int, day: Column | int) -> Column:
    """Date from its fields."""
    return F.make_date(*(F.lit(x) if isinstance(x, int) else x for x in (year, month, day)))


def make_datetime(year, month, day, hour=0, minute=0, second=0, microsecond=0, tz=None) -> Column:
    """Timestamp from its fields; with ``tz`` the fields are local there and the result is UTC."""
    fields = [F.lit(x) if isinstance(x, int) else x for x in (year, month, day, hour, minute)]
    second, microsecond = (F.lit(x) if isinstance(x, int) else x for x in (second, microsecond))
    seconds = (second + microsecond / 1_000_000).cast("decimal(8,6)")
    local = F.make_timestamp_ntz(*fields, seconds)
    return convert_timezone(local, "UTC", tz) if tz else local


# --- relative to now ------------------------------------------------------------


def now(tz: str = "UTC", as_of: Column | None = None) -> Column:
    """Current wall-clock time in ``tz``."""
    if as_of is None:
        return F.convert_timezone(F.current_timezone(), F.lit(tz), F.localtimestamp())
    return convert_timezone(as_of, tz)


def today(tz: str = "UTC", as_of: Column | None = None) -> Column:
    """Current date in ``tz``."""
    return now(tz, as_of).cast("date")


def n_days_ago(n: int, date: Column | None = None, tz: str = "UTC", as_of: Column | None = None) -> Column:
    """``n`` days before ``date`` (default today)."""
    return F.date_sub((today(tz, as_of) if date is None else date).cast("date"), n)


def n_days_away(n: int, date: Column | None = None, tz: str = "UTC", as_of: Column | None = None) -> Column:
    """``n`` days after ``date`` (default today)."""
    return n_days_ago(-n, date, tz, as_of)


def yesterday(date: Column | None = None, tz: str = "UTC", as_of: Column | None = None) -> Column:
    """The day before."""
    return n_days_ago(1, date, tz, as_of)


def tomorrow(date: Column | None = None, tz: str = "UTC", as_of: Column | None = None) -> Column:
    """The day after."""
    return n_days_away(1, date, tz, as_of)


def n_weeks_ago(n: int, tz: str = "UTC", as_of: Column | None = None) -> Column:
    """Monday of the week ``n`` weeks before today."""
    return F.trunc(n_days_ago(7 * n, tz=tz, as_of=as_of), "week")


def n_weeks_away(n: int, tz: str = "UTC", as_of: Column | None = None) -> Column:
    """Monday of the week ``n`` weeks after today."""
    return n_weeks_ago(-n, tz, as_of)


def n_months_ago(n: int, tz: str = "UTC", as_of: Column | None = None) -> Column:
    """First day of the month ``n`` months before today."""
    return F.trunc(F.add_months(today(tz, as_of), -n), "month")


def n_months_away(n: int, tz: str = "UTC", as_of: Column | None = None) -> Column:
    """First day of the month ``n`` months after today."""
    return n_months_ago(-n, tz, as_of)


def last_week(tz: str = "UTC", as_of: Column | None = None) -> Column:
    """Monday of the previous week."""
    return n_weeks_ago(1, tz, as_of)


def next_week(tz: str = "UTC", as_of: Column | None = None) -> Column:
    """Monday of the next week."""
    return n_weeks_away(1, tz, as_of)


def last_month(tz: str = "UTC", as_of: Column | None = None) -> Column:
    """First day of the previous month."""
    return n_months_ago(1, tz, as_of)


def next_month(tz: str = "UTC", as_of: Column | None = None) -> Column:
    """First day of the next month."""
    return n_months_away(1, tz, as_of)


def last_month_name(short: bool = True, tz: str = "UTC", as_of: Column | None = None) -> Column:
    """Name of the previous month."""
    return month_name(last_month(tz, as_of), short)


def next_month_name(short: bool = True, tz: str = "UTC", as_of: Column | None = None) -> Column:
    """Name of the next month."""
    return month_name(next_month(tz, as_of), short)


def last_month_number(tz: str = "UTC", as_of: Column | None = None) -> Column:
    """Number of the previous month."""
    return date_part("month", last_month(tz, as_of))


def next_month_number(tz: str = "UTC", as_of: Column | None = None) -> Column:
    """Number of the next month."""
    return date_part("month", next_month(tz, as_of))


def periods_since(value: Column | str, period: str = "day", tz: str = "UTC", as_of: Column | None = None) -> Column:
    """Period boundaries between the value and now."""
    return datediff(value, now(tz, as_of), period)
