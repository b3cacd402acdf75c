"""Checks on one column's values and on aggregates of one column."""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.numbers import regexp_match
from larder.operators.expectations.core import Predicate, as_column, bounds_hold, failing, where
from larder.operators.ordered import percentile_cont
from larder.operators.sweep import swept

PREDICATES: dict[str, Callable[..., Predicate]] = {}


def expectation(build: Callable[..., Predicate]) -> Callable[..., DataFrame]:
    """Turn a function that states a predicate into a check that returns the failing rows.

    The statement itself stays available by name for suites.
    """
    PREDICATES[build.__name__] = build

    @wraps(build)
    def check(df: DataFrame, *args, **kwargs) -> DataFrame:
        return failing(df, build(*args, **kwargs))

    check.predicate = build
    return check


# --- one value at a time -------------------------------------------------------------


@expectation
def expect_column_values_to_be_between(column, min_value=None, max_value=None, row_condition=None, strictly=False):
    """Value within the bounds."""
    return Predicate(bounds_hold(as_column(column), min_value, max_value, strictly), row_condition=row_condition)


@expectation
def expect_column_values_to_be_null(column, row_condition=None):
    """Value is missing."""
    return Predicate(as_column(column).isNull(), row_condition=row_condition)


@expectation
def expect_column_values_to_not_be_null(column, row_condition=None):
    """Value is present."""
    return Predicate(as_column(column).isNotNull(), row_condition=row_condition)


@expectation
def expect_column_value_lengths_to_be_between(column, min_value=None, max_value=None, row_condition=None, strictly=False):
    """Number of characters within the bounds."""
    length = F.length(as_column(column))
    return Predicate(bounds_hold(length, min_value, max_value, strictly), row_condition=row_condition)


@expectation
def expect_column_value_lengths_to_equal(column, value, row_condition=None):
    """Exactly this many characters."""
    return Predicate(F.length(as_column(column)) == value, row_condition=row_condition)


def _combine(parts: Sequence[Column], match_on: str) -> Column:
    return reduce(operator.and_ if match_on == "all" else operator.or_, parts)


@expectation
def expect_column_values_to_match_like_pattern(column, like_pattern, row_condition=None):
    """Text matches the LIKE pattern."""
    return Predicate(as_column(column).like(like_pattern), row_condition=row_condition)


@expectation
def expect_column_values_to_not_match_like_pattern(column, like_pattern, row_condition=None):
    """Text does not match the LIKE pattern."""
    return Predicate(~as_column(column).like(like_pattern), row_condition=row_condition)


@expectation
def expect_column_values_to_match_like_pattern_list(column, like_pattern_list, match_on="any", row_condition=None):
    """Text matches any, or all, of the patterns."""
    parts = [as_column(column).like(p) for p in like_pattern_list]
    return Predicate(_combine(parts, match_on), row_condition=row_condition)


@expectation
def expect_column_values_to_not_match_like_pattern_list(column, like_pattern_list, match_on="any", row_condition=None):
    """Text misses at least one of the patterns, or with "all" every one."""
    parts = [~as_column(column).like(p) for p in like_pattern_list]
    return Predicate(_combine(parts, match_on), row_condition=row_condition)


@expectation
def expect_column_values_to_match_regex(column, regex, row_condition=None, is_raw=False, flags=""):
    """Regex found anywhere in the text. Patterns are passed on as they are, so ``is_raw``
    changes nothing."""
    return Predicate(regexp_match(as_column(column), regex, flags), row_condition=row_condition)


@expectation
def expect_column_values_to_not_match_regex(column, regex, row_condition=None, is_raw=False, flags=""):
    """Regex found nowhere in the text."""
    return Predicate(~regexp_match(as_column(column), regex, flags), row_condition=row_condition)


@expectation
def expect_column_values_to_match_regex_list(
    column, regex_list, match_on="any", row_condition=None, is_raw=False, flags=""
):
    """Any, or all, of the regexes found."""
    parts = [regexp_match(as_column(column), r, flags) for r in regex_list]
    return Predicate(_combine(parts, match_on), row_condition=row_condition)


@expectation
def expect_column_values_to_not_match_regex_list(
    column, regex_list, match_on="any", row_condition=None, is_raw=False, flags=""
):
    """At least one of the regexes not found, or with "all" none found."""
    parts = [~regexp_match(as_column(column), r, flags) for r in regex_list]
    return Predicate(_combine(parts, match_on), row_condition=row_condition)


# --- several columns of one row -------------------------------------------------------


@expectation
def expect_column_pair_values_A_to_be_greater_than_B(column_a, column_b, or_equal=False, row_condition=None):
    """First greater than second; both may be expressions."""
    compare = operator.ge if or_equal else operator.gt
    return Predicate(compare(as_column(column_a), as_column(column_b)), row_condition=row_condition)


@expectation
def expect_column_pair_values_to_be_equal(column_a, column_b, row_condition=None):
    """Both equal."""
    return Predicate(as_column(column_a) == as_column(column_b), row_condition=row_condition)


@expectation
def expect_column_pair_values_to_be_in_set(column_a, column_b, value_pairs_set, row_condition=None):
    """The pair is one of those listed."""
    for pair in value_pairs_set:
        if len(pair) != 2:
            raise ValueError(f"every element of value_pairs_set needs two items, got {pair!r}")
    a, b = as_column(column_a), as_column(column_b)
    pairs = [(a == F.lit(x)) & (b == F.lit(y)) for x, y in value_pairs_set]
    return Predicate(reduce(operator.or_, pairs), row_condition=row_condition)


# --- aggregates -----------------------------------------------------------------------


def _aggregate_between(value: Column, min_value, max_value, group_by, row_condition, strictly) -> Predicate:
    holds = bounds_hold(value, min_value, max_value, strictly)
    return Predicate(holds, True, tuple(group_by or ()), row_condition)


def _between_check(name: str, aggregate: Callable[[Column], Column], doc: str) -> Callable[..., DataFrame]:
    def build(column, min_value=None, max_value=None, group_by=None, row_condition=None, strictly=False):
        value = aggregate(as_column(column))
        return _aggregate_between(value, min_value, max_value, group_by, row_condition, strictly)

    build.__name__ = build.__qualname__ = name
    build.__doc__ = doc
    return expectation(build)


expect_column_max_to_be_between = _between_check(
    "expect_column_max_to_be_between", F.max, "Greatest value within the bounds."
)
expect_column_min_to_be_between = _between_check(
    "expect_column_min_to_be_between", F.min, "Least value within the bounds."
)
expect_column_mean_to_be_between = _between_check(
    "expect_column_mean_to_be_between", F.avg, "Mean within the bounds."
)
expect_column_sum_to_be_between = _between_check(
    "expect_column_sum_to_be_between", F.sum, "Sum within the bounds."
)
expect_column_stdev_to_be_between = _between_check(
    "expect_column_stdev_to_be_between", F.stddev_samp, "Sample standard deviation within the bounds."
)
expect_column_unique_value_count_to_be_between = _between_check(
    "expect_column_unique_value_count_to_be_between", F.countDistinct, "Number of distinct values within the bounds."
)
expect_column_proportion_of_unique_values_to_be_between = _between_check(
    "expect_column_proportion_of_unique_values_to_be_between",
    lambda c: F.try_divide(F.countDistinct(c).cast("double"), F.count(c)),
    "Distinct values per non-missing value within the bounds.",
)


def _distinct_check(name: str, compare: Callable, doc: str) -> Callable[..., DataFrame]:
    def build(column, value, group_by=None, row_condition=None):
        holds = compare(F.countDistinct(as_column(column)), F.lit(value))
        return Predicate(holds, True, tuple(group_by or ()), row_condition)

    build.__name__ = build.__qualname__ = name
    build.__doc__ = doc
    return expectation(build)


expect_column_distinct_count_to_equal = _distinct_check(
    "expect_column_distinct_count_to_equal", operator.eq, "Exactly this many distinct values."
)
expect_column_distinct_count_to_be_greater_than = _distinct_check(
    "expect_column_distinct_count_to_be_greater_than", operator.gt, "More distinct values than this."
)
expect_column_distinct_count_to_be_less_than = _distinct_check(
    "expect_column_distinct_count_to_be_less_than", operator.lt, "Fewer distinct values than this."
)


def expect_column_quantile_values_to_be_between(
    df: DataFrame, column: str, quantile: float, min_value=None, max_value=None, group_by=None,
    row_condition=None, strictly: bool = False,
) -> DataFrame:
    """Fails where the interpolated quantile lies outside the bounds.

    Exact: found by counting over the ordered distinct values, see ``percentile_cont``.
    """
    groups = [as_column(g).alias(f"col_{i}") for i, g in enumerate(group_by or (), 1)]
    names = [f"col_{i}" for i in range(1, len(groups) + 1)]
    values = where(df, row_condition).select(*groups, as_column(column).alias("_checked"))
    quantiles = percentile_cont(values, "_checked", quantile, names, out="_quantile")
    holds = bounds_hold(F.col("_quantile"), min_value, max_value, strictly)
    return quantiles.select(*names, holds.alias("expression")).filter(~(F.col("expression") == F.lit(True)))


def expect_column_median_to_be_between(
    df: DataFrame, column: str, min_value=None, max_value=None, group_by=None, row_condition=None,
    strictly: bool = False,
) -> DataFrame:
    """Fails where the median lies outside the bounds."""
    return expect_column_quantile_values_to_be_between(
        df, column, 0.5, min_value, max_value, group_by, row_condition, strictly
    )


@expectation
def expect_multicolumn_sum_to_equal(column_list, sum_total, group_by=None, row_condition=None):
    """The columns' sums add up to a number, or to the sum of another column."""
    total = reduce(operator.add, (F.sum(as_column(c)) for c in column_list))
    wanted = F.lit(sum_total) if isinstance(sum_total, (int, float)) else F.sum(as_column(sum_total))
    return Predicate(total == wanted, True, tuple(group_by or ()), row_condition)


# --- order of values --------------------------------------------------------------------


def _monotone(df, column, sort_column, strictly, row_condition, group_by, step, rising: bool, show_groups: bool):
    groups = list(group_by or ())
    rows = where(df, row_condition).select(
        as_column(sort_column or column).alias("sort_column"),
        *(as_column(g).alias(f"_group_{i}") for i, g in enumerate(groups)),
        as_column(column).alias("value_field"),
    )
    keys = [f"_group_{i}" for i in range(len(groups))]
    order = ["sort_column", "value_field"]
    copies = swept(rows, keys, order, {"value_field": "value_field_lag"})
    value, before = F.col("value_field"), F.col("value_field_lag")
    compare = {(True, True): operator.gt, (True, False): operator.ge, (False, True): operator.lt, (False, False): operator.le}
    holds = compare[rising, strictly](value, before)
    if step:
        holds = holds & ((value - before if rising else before - value) == step)
    shown = [F.col(k).alias(g) for k, g in zip(keys, groups)] if show_groups else []
    return copies.filter(before.isNotNull() & ~holds).select("sort_column", *shown, "value_field", "value_field_lag")


def expect_column_values_to_be_increasing(
    df: DataFrame, column: str, sort_column: str | None = None, strictly: bool = True, row_condition=None,
    group_by: Sequence[str] | None = None, step: float | None = None,
) -> DataFrame:
    """Fails where a value does not exceed (or, not strictly, reach) the one before it in
    sort order, or differs from it by other than ``step``. Equal sort values are ordered by
    value. Works for any number of rows per group and without groups."""
    return _monotone(df, column, sort_column, strictly, row_condition, group_by, step, True, True)


def expect_column_values_to_be_decreasing(
    df: DataFrame, column: str, sort_column: str | None = None, strictly: bool = True, row_condition=None,
    group_by: Sequence[str] | None = None, step: float | None = None,
) -> DataFrame:
    """The mirror image of the increasing check; group columns are not part of the output."""
    return _monotone(df, column, sort_column, strictly, row_condition, group_by, step, False, False)


# --- spelling ---------------------------------------------------------------------------


def expect_column_values_to_have_consistent_casing(
    df: DataFrame, column: str, display_inconsistent_columns: bool = False
) -> DataFrame:
    """Fails when values differ by case only.

    The default form compares two counts, and the first one includes a missing value; the
    display form lists the lower-cased values with their number of spellings.
    """
    spellings = df.select(as_column(column).alias("distinct_values")).distinct()
    folded = F.lower("distinct_values")
    if display_inconsistent_columns:
        return (
            spellings.groupBy(folded.alias("inconsistent_columns"))
            .agg(F.count("distinct_values").alias("set_count_case_insensitive"))
            .filter(F.col("set_count_case_insensitive") > 1)
        )
    return spellings.agg(
        F.count(F.lit(1)).alias("set_count"),
        F.countDistinct(folded).alias("set_count_case_insensitive"),
    ).filter(F.col("set_count") != F.col("set_count_case_insensitive"))


__all__ = [name for name in list(globals()) if name.startswith("expect_")] + ["PREDICATES"]
