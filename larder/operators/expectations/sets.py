"""Checks of a column against a list of values.

The list is part of the plan as literals. Rows are tested in place or reduced to distinct
values; the table never joins against the list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.expectations.columns import PREDICATES
from larder.operators.expectations.core import Predicate, as_column, where

__all__ = [
    "expect_column_values_to_be_in_set",
    "expect_column_values_to_not_be_in_set",
    "expect_column_distinct_values_to_be_in_set",
    "expect_column_distinct_values_to_contain_set",
    "expect_column_distinct_values_to_equal_set",
    "expect_column_most_common_value_to_be_in_set",
]


def _literals(value_set: Sequence, quote_values: bool) -> list[Column]:
    """Texts, or with ``quote_values=False`` SQL expressions and plain values."""
    if quote_values:
        return [F.lit(str(v)) for v in value_set]
    return [F.expr(v) if isinstance(v, str) else F.lit(v) for v in value_set]


def _values(df: DataFrame, column: str, quote_values: bool, row_condition) -> DataFrame:
    value = as_column(column)
    return where(df, row_condition).select((value.cast("string") if quote_values else value).alias("value_field"))


def _outside(listed: list[Column]) -> Column:
    return F.col("value_field").isNull() | ~F.col("value_field").isin(*listed)


def expect_column_values_to_be_in_set(
    df: DataFrame, column: str, value_set: Sequence, quote_values: bool = True, row_condition=None
) -> DataFrame:
    """Fails for each row whose value is not listed; a missing value fails."""
    rows = _values(df, column, quote_values, row_condition)
    return rows.filter(_outside(_literals(value_set, quote_values)))


def expect_column_values_to_not_be_in_set(
    df: DataFrame, column: str, value_set: Sequence, quote_values: bool = True, row_condition=None
) -> DataFrame:
    """Fails for each row whose value is listed, once per time it is listed."""
    listed = _literals(value_set, quote_values)
    rows = _values(df, column, quote_values, row_condition).filter(F.col("value_field").isin(*listed))
    hits = F.filter(F.array(*listed), lambda item: item == F.col("value_field"))
    return rows.withColumn("_hit", F.explode(hits)).select("value_field")


def _stated(column: str, value_set: Sequence, quote_values: bool) -> Column:
    value = as_column(column)
    listed = (value.cast("string") if quote_values else value).isin(*_literals(value_set, quote_values))
    return F.coalesce(listed, F.lit(False))


def _in_set(column: str, value_set: Sequence, quote_values: bool = True, row_condition=None) -> Predicate:
    return Predicate(_stated(column, value_set, quote_values), row_condition=row_condition)


def _not_in_set(column: str, value_set: Sequence, quote_values: bool = True, row_condition=None) -> Predicate | None:
    # A value that is listed twice fails twice, which no predicate says.
    if len(set(value_set)) < len(value_set):
        return None
    return Predicate(~_stated(column, value_set, quote_values), row_condition=row_condition)


# What a suite can evaluate in the table's one scan.
PREDICATES["expect_column_values_to_be_in_set"] = _in_set
PREDICATES["expect_column_values_to_not_be_in_set"] = _not_in_set


def expect_column_distinct_values_to_be_in_set(
    df: DataFrame, column: str, value_set: Sequence, quote_values: bool = True, row_condition=None
) -> DataFrame:
    """Fails for each distinct value not listed; a missing value fails."""
    return expect_column_values_to_be_in_set(df, column, value_set, quote_values, row_condition).distinct()


def expect_column_distinct_values_to_contain_set(
    df: DataFrame, column: str, value_set: Sequence, quote_values: bool = True, row_condition=None
) -> DataFrame:
    """Fails for each listed value that no row has."""
    listed = _literals(value_set, quote_values)
    # At most as many rows as the list has values.
    present = _values(df, column, quote_values, row_condition).filter(F.col("value_field").isin(*listed)).distinct()
    wanted = df.sparkSession.range(1).select(F.explode(F.array_distinct(F.array(*listed))).alias("value_field"))
    return wanted.join(F.broadcast(present), "value_field", "left_anti")


def expect_column_distinct_values_to_equal_set(
    df: DataFrame, column: str, value_set: Sequence, quote_values: bool = True, row_condition=None
) -> DataFrame:
    """Fails for each distinct value not listed (``column_value``) and each listed value not
    found (``value_field``)."""
    extra = expect_column_distinct_values_to_be_in_set(df, column, value_set, quote_values, row_condition)
    missing = expect_column_distinct_values_to_contain_set(df, column, value_set, quote_values, row_condition)
    kind = missing.schema["value_field"].dataType
    return extra.select(
        F.col("value_field").alias("column_value"), F.lit(None).cast(kind).alias("value_field")
    ).unionByName(
        missing.select(F.lit(None).cast(extra.schema["value_field"].dataType).alias("column_value"), "value_field")
    )


def expect_column_most_common_value_to_be_in_set(
    df: DataFrame,
    column: str,
    value_set: Sequence,
    top_n: int,
    quote_values: bool = True,
    data_type: str = "decimal(18,3)",
    row_condition=None,
) -> DataFrame:
    """Fails when the value at frequency rank ``top_n`` is not listed.

    Exactly that rank is looked at, not the ranks before it; equal frequencies are ordered
    by value. Without ``quote_values`` both sides are cast to ``data_type``.
    """
    value = as_column(column).cast("string") if quote_values else as_column(column).cast(data_type)
    listed = _literals(value_set, quote_values)
    if not quote_values:
        listed = [item.cast(data_type) for item in listed]
    counts = where(df, row_condition).groupBy(value.alias("value_field")).agg(F.count(F.lit(1)).alias("value_count"))
    order = [F.desc("value_count"), F.asc_nulls_last("value_field")]
    # A distributed top-n first; the rank is then taken over those n rows only.
    leaders = counts.orderBy(*order).limit(top_n)
    ranked = leaders.withColumn("_rank", F.row_number().over(Window.orderBy(*order)))
    return ranked.filter((F.col("_rank") == top_n) & ~F.col("value_field").isin(*listed)).select("value_field")
