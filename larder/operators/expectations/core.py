"""The three generalized checks: an expression is true, lies between bounds, equals another."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "Predicate",
    "as_column",
    "equal_expression",
    "expression_between",
    "expression_is_true",
    "failing",
    "ignore_row_if",
    "where",
]


def as_column(expression: Column | str) -> Column:
    """SQL text or column."""
    return F.expr(expression) if isinstance(expression, str) else expression


def where(df: DataFrame, row_condition: Column | str | None) -> DataFrame:
    """The rows a check looks at."""
    return df if row_condition is None else df.filter(as_column(row_condition))


@dataclass(frozen=True)
class Predicate:
    """What must hold: per row, or (``aggregate``) per table or group.

    Keeping the statement apart from the query that applies it lets a suite evaluate many
    of them in one scan.
    """

    expression: Column
    aggregate: bool = False
    group_by: tuple[str, ...] = ()
    row_condition: Column | str | None = None
    wanted: bool = True

    @property
    def fails(self) -> Column:
        """True for a failure; NULL (unknown) and true are no failures."""
        return ~(self.expression == F.lit(self.wanted))


def failing(df: DataFrame, predicate: Predicate) -> DataFrame:
    """Rows or groups that break a predicate: ``col_1..col_n`` (groups) and ``expression``."""
    rows = where(df, predicate.row_condition)
    broken = ~(F.col("expression") == F.lit(predicate.wanted))
    groups = [as_column(g).alias(f"col_{i}") for i, g in enumerate(predicate.group_by, 1)]
    value = predicate.expression.alias("expression")
    if predicate.aggregate or groups:
        result = rows.groupBy(*groups).agg(value) if groups else rows.agg(value)
    else:
        result = rows.select(value)
    return result.filter(broken)


def expression_is_true(
    df: DataFrame,
    expression: Column | str,
    test_condition: str = "= true",
    group_by: Sequence[str] | None = None,
    row_condition: Column | str | None = None,
    aggregate: bool = False,
) -> DataFrame:
    """Fails where the expression does not meet ``test_condition`` (default: is true).

    With ``group_by``, or ``aggregate=True`` for the whole table, the expression is an
    aggregate.
    """
    rows = where(df, row_condition)
    groups = [as_column(g).alias(f"col_{i}") for i, g in enumerate(group_by or (), 1)]
    value = as_column(expression).alias("expression")
    if groups:
        result = rows.groupBy(*groups).agg(value)
    else:
        result = rows.agg(value) if aggregate else rows.select(value)
    return result.filter(f"NOT (expression {test_condition})")


def bounds_hold(value: Column, min_value=None, max_value=None, strictly: bool = False) -> Column:
    """The value lies within the bounds; at least one is needed."""
    if min_value is None and max_value is None:
        raise ValueError("provide min_value, max_value or both")
    above, below = (operator.gt, operator.lt) if strictly else (operator.ge, operator.le)
    parts = []
    if min_value is not None:
        parts.append(above(value, as_column(min_value) if isinstance(min_value, (str, Column)) else F.lit(min_value)))
    if max_value is not None:
        parts.append(below(value, as_column(max_value) if isinstance(max_value, (str, Column)) else F.lit(max_value)))
    return reduce(operator.and_, parts)


def expression_between(
    df: DataFrame,
    expression: Column | str,
    min_value=None,
    max_value=None,
    group_by: Sequence[str] | None = None,
    row_condition: Column | str | None = None,
    strictly: bool = False,
    aggregate: bool = False,
) -> DataFrame:
    """Fails where the expression lies outside the bounds, which belong to the range unless
    ``strictly``."""
    holds = bounds_hold(as_column(expression), min_value, max_value, strictly)
    return failing(df, Predicate(holds, aggregate, tuple(group_by or ()), row_condition))


def _summary(df: DataFrame, expression: Column | str, group_by: Sequence[str], row_condition, side: str) -> DataFrame:
    rows = where(df, row_condition)
    groups = [as_column(g).alias(f"col_{i}") for i, g in enumerate(group_by, 1)]
    value = as_column(expression).alias(side)
    return rows.groupBy(*groups).agg(value) if groups else rows.agg(value)


def equal_expression(
    df: DataFrame,
    expression: Column | str,
    compare_df: DataFrame | None = None,
    compare_expression: Column | str | None = None,
    group_by: Sequence[str] | None = None,
    compare_group_by: Sequence[str] | None = None,
    row_condition: Column | str | None = None,
    compare_row_condition: Column | str | None = None,
    tolerance: float = 0.0,
    tolerance_percent: float | None = None,
) -> DataFrame:
    """Fails where two aggregates differ by more than the tolerance, per group or overall.

    A missing aggregate counts as 0. Both tables are aggregated before they meet. Groups
    named NULL do not match each other. A ``tolerance_percent`` of 0 means none given.
    """
    group_by = list(group_by or ())
    left = _summary(df, expression, group_by, row_condition, "expression")
    right = _summary(
        df if compare_df is None else compare_df,
        expression if compare_expression is None else compare_expression,
        list(compare_group_by or group_by),
        row_condition if compare_row_condition is None else compare_row_condition,
        "compare_expression",
    )
    names = [f"col_{i}" for i in range(1, len(group_by) + 1)]
    if names:
        both = left.join(right, names, "full")
    else:
        # Two single rows: one frame looks up the other's value, no join is needed.
        both = left.withColumn("compare_expression", right.scalar())
    a, b = F.col("expression"), F.col("compare_expression")
    difference = F.abs(F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))
    share = F.col("expression_difference") / F.nullif(a * F.lit(1.0), F.lit(0.0))
    compared = both.select(*names, a, b, difference.alias("expression_difference")).withColumn(
        "expression_difference_percent", share
    )
    if tolerance_percent:
        return compared.filter(F.col("expression_difference_percent") > tolerance_percent)
    return compared.filter(F.col("expression_difference") > tolerance)


def ignore_row_if(mode: str, columns: Sequence[str]) -> Column:
    """Condition that keeps a row unless all, or any, of the columns are missing."""
    modes = {"all_values_are_missing": operator.and_, "any_value_is_missing": operator.or_}
    if mode not in modes:
        raise ValueError(f"`ignore_row_if` must be one of {', '.join(modes)}, not {mode!r}")
    return ~reduce(modes[mode], (as_column(c).isNull() for c in columns))
