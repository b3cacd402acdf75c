"""Numeric column helpers: exact sums, decimal rounding, logarithm, hashing, random."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Grid steps of the first three bins of a sum, as powers of two. An addend of at least 2 ** 100 is not cut.
GREAT, HIGH, MIDDLE, UNCUT = 50, 0, -26, 100


def _on_grid(value: Column, power: int) -> Column:
    """The multiple of ``2 ** power`` next to the value; exact, since both factors are powers of two."""
    return F.rint(value * F.lit(2.0**-power)) * F.lit(2.0**power)


def sum_parts(value: Column) -> Column:
    """SUM of doubles in four bins whose sums do not depend on row order, retries or partitioning.

    An addend is cut on fixed grids: a multiple of 2 ** 50, one of 1, one of 2 ** -26, and what remains. Each bin adds up
    multiples of its own step, which a double holds exactly as long as its sum stays below 2 ** 53 steps: sums
    up to 9e15 (and, apart, of greater numbers up to 1e31) are exact in any order, and beyond that as good as SUM; so
    is what remains of numbers below one. Small addends are not lost beside great ones. NULL if no value is there; NaN and infinity give what SUM gives.
    :func:`merged_parts` sums such sums.
    """
    value = value.cast("double")
    size = F.abs(value)
    whole = size >= F.lit(2.0**UNCUT)  # NaN and infinity too: NaN is the greatest number here
    great = F.when(whole, value).otherwise(F.when(size >= F.lit(2.0 ** (GREAT - 1)), _on_grid(value, GREAT)).otherwise(value * F.lit(0.0)))
    left = F.when(whole, F.lit(0.0)).otherwise(value - great)
    high = _on_grid(left, HIGH)
    low = left - high
    middle = _on_grid(low, MIDDLE)
    return F.struct(F.sum(great).alias("great"), F.sum(high).alias("high"), F.sum(middle).alias("middle"), F.sum(low - middle).alias("rest"))


def merged_parts(parts: Column) -> Column:
    """SUM over the results of :func:`sum_parts`."""
    return F.struct(*(F.sum(parts[name]).alias(name) for name in ("great", "high", "middle", "rest")))


def parts_value(parts: Column) -> Column:
    """The sum as a double."""
    return parts["great"] + (parts["high"] + (parts["middle"] + parts["rest"]))


def parts_rounded(parts: Column, places: int) -> Column:
    """The sum rounded half away from zero."""
    return rounded(parts_value(parts), places)


def exact_sum(value: Column) -> Column:
    """SUM that does not depend on row order, as a double; see :func:`sum_parts`."""
    return parts_value(sum_parts(value))


def exact_avg(value: Column) -> Column:
    """Mean over non-NULL values on top of :func:`exact_sum`; NULL when there is none."""
    return exact_sum(value) / F.nullif(F.count(value), F.lit(0))


def rounded_sum(value: Column, places: int) -> Column:
    """Exact sum, rounded once."""
    return parts_rounded(sum_parts(value), places)


def rounded(value: Column, places: int) -> Column:
    """ROUND half away from zero of the double as written in decimal: 2.675 becomes 2.68, and -0.0 becomes 0.0."""
    return F.round(value.cast("double"), places) + F.lit(0.0)


def to_int(value: Column) -> Column:
    """Cast a non-integer number to INT by rounding, not by truncating."""
    return F.round(value).cast("int")


def log_natural(value: Column) -> Column:
    """Natural logarithm; NULL for zero, where callers use NULLIF(x, 0)."""
    return F.ln(F.nullif(value, F.lit(0)))


def md5_text(value: Column) -> Column:
    """MD5 of the value's text form, as lower-case hex."""
    return F.md5(value.cast("string"))


def random_uniform(seed: int | None = None) -> Column:
    """Uniform random number in [0, 1)."""
    return F.rand(seed) if seed is not None else F.rand()


def regexp_match(value: Column, regex: str, flags: str = "") -> Column:
    """True when ``regex`` matches anywhere in the text.

    ``i`` ignores case, ``c`` (the default) does not. ``e`` and ``p`` are accepted and
    change nothing; any other letter only warns.
    """
    known = "ciep"
    unknown = sorted(set(flags) - set(known))
    if unknown:
        import warnings

        warnings.warn(f"regex flags {unknown} are not in the allowed list {list(known)}")
    last_case_flag = next((f for f in reversed(flags) if f in "ci"), "c")
    return F.regexp_like(value, F.lit("(?i)" + regex if last_case_flag == "i" else regex))
