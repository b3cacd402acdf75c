"""Checks of a table's shape: columns, types, row counts, freshness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import dates as d
from larder.operators.expectations.columns import expectation
from larder.operators.expectations.core import Predicate, as_column, bounds_hold, equal_expression, where

# Type names as written for either engine, upper-cased -> Spark's name
TYPE_NAMES = {
    "VARCHAR": "string",
    "TEXT": "string",
    "STRING": "string",
    "BIGINT": "bigint",
    "LONG": "bigint",
    "INT8": "bigint",
    "HUGEINT": "decimal(38,0)",
    "INTEGER": "int",
    "INT": "int",
    "SMALLINT": "smallint",
    "SHORT": "smallint",
    "TINYINT": "tinyint",
    "DOUBLE": "double",
    "FLOAT": "float",
    "REAL": "float",
    "BOOLEAN": "boolean",
    "BOOL": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMP_NTZ": "timestamp_ntz",
    "TIMESTAMP WITH TIME ZONE": "timestamp",
    "TIMESTAMPTZ": "timestamp",
    "TIMESTAMP_LTZ": "timestamp",
    "BLOB": "binary",
    "BINARY": "binary",
}


def _fold(names: Sequence[str], transform: str = "upper") -> list[str]:
    return [n.upper() if transform == "upper" else n.lower() if transform == "lower" else n for n in names]


def _frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A metadata result: a handful of rows, no table is read."""
    return spark.createDataFrame(rows, schema)


# --- columns ---------------------------------------------------------------------------


def expect_column_to_exist(
    df: DataFrame, column: str, column_index: int | None = None, transform: str = "upper"
) -> DataFrame:
    """Fails when the column is absent, or not at the 1-based position (0 is not checked)."""
    name, names = _fold([column], transform)[0], _fold(df.columns, transform)
    found = names.index(name) if name in names else -1
    right_place = not column_index or found == max(column_index - 1, 0)
    rows = [] if found >= 0 and right_place else [(name, found, right_place)]
    return _frame(df.sparkSession, rows, "column_name string, matching_column_index int, column_index_matches boolean")


def expect_table_column_count_to_be_between(df: DataFrame, min_value=None, max_value=None) -> DataFrame:
    """Fails when the number of columns lies outside the bounds; a bound of 0 is not checked."""
    if min_value is None and max_value is None:
        raise ValueError("provide min_value, max_value or both")
    n = len(df.columns)
    holds = (not min_value or n >= min_value) and (not max_value or n <= max_value)
    rows = [] if holds else [(n, min_value or 0, max_value or 0)]
    return _frame(df.sparkSession, rows, "number_actual_columns int, min_value int, max_value int")


def expect_table_column_count_to_equal(df: DataFrame, value: int) -> DataFrame:
    """Fails when the number of columns differs."""
    n = len(df.columns)
    return _frame(df.sparkSession, [] if n == value else [(n, value)], "number_actual_columns int, value int")


def expect_table_column_count_to_equal_other_table(df: DataFrame, compare_df: DataFrame) -> DataFrame:
    """Fails when the tables have different numbers of columns."""
    a, b = len(df.columns), len(compare_df.columns)
    return _frame(df.sparkSession, [] if a == b else [(a, b)], "number_columns int, compare_number_columns int")


def expect_table_columns_to_contain_set(df: DataFrame, column_list: Sequence[str], transform: str = "upper") -> DataFrame:
    """Fails for each listed column the table lacks."""
    have = set(_fold(df.columns, transform))
    rows = [(name, None) for name in _fold(column_list, transform) if name not in have]
    return _frame(df.sparkSession, rows, "input_column string, relation_column string")


def expect_table_columns_to_not_contain_set(
    df: DataFrame, column_list: Sequence[str], transform: str = "upper"
) -> DataFrame:
    """Fails for each listed column the table has."""
    have = set(_fold(df.columns, transform))
    rows = [(name, name) for name in _fold(column_list, transform) if name in have]
    return _frame(df.sparkSession, rows, "input_column string, relation_column string")


def expect_table_columns_to_match_set(df: DataFrame, column_list: Sequence[str], transform: str = "upper") -> DataFrame:
    """Fails for each column that only the table or only the list has."""
    have, listed = _fold(df.columns, transform), _fold(column_list, transform)
    rows = [(name, None) for name in have if name not in listed]
    rows += [(None, name) for name in listed if name not in have]
    return _frame(df.sparkSession, rows, "relation_column string, input_column string")


def expect_table_columns_to_match_ordered_list(
    df: DataFrame, column_list: Sequence[str], transform: str = "upper"
) -> DataFrame:
    """Fails for each name and position that only the table or only the list has."""
    have = list(enumerate(_fold(df.columns, transform), 1))
    listed = list(enumerate(_fold(column_list, transform), 1))
    rows = [(*item, None, None) for item in have if item not in listed]
    rows += [(None, None, *item) for item in listed if item not in have]
    schema = "relation_column_idx int, relation_column string, input_column_idx int, input_column string"
    return _frame(df.sparkSession, rows, schema)


def expect_column_values_to_be_in_type_list(df: DataFrame, column: str, column_type_list: Sequence[str]) -> DataFrame:
    """Fails when the column's type is not listed; an absent column passes."""
    wanted = {TYPE_NAMES.get(t.upper(), t.lower()) for t in column_type_list}
    rows = [
        (f.name.upper(), f.dataType.simpleString().upper())
        for f in df.schema
        if f.name.upper() == column.upper() and f.dataType.simpleString() not in wanted
    ]
    return _frame(df.sparkSession, rows, "relation_column string, relation_column_type string")


def expect_column_values_to_be_of_type(df: DataFrame, column: str, column_type: str) -> DataFrame:
    """Fails when the column has another type."""
    return expect_column_values_to_be_in_type_list(df, column, [column_type])


# --- row counts --------------------------------------------------------------------------


@expectation
def expect_table_row_count_to_be_between(min_value=None, max_value=None, group_by=None, row_condition=None, strictly=False):
    """Number of rows within the bounds."""
    holds = bounds_hold(F.count(F.lit(1)), min_value, max_value, strictly)
    return Predicate(holds, True, tuple(group_by or ()), row_condition)


@expectation
def expect_table_row_count_to_equal(value, group_by=None, row_condition=None):
    """Exactly this many rows."""
    return Predicate(F.count(F.lit(1)) == value, True, tuple(group_by or ()), row_condition)


def expect_table_aggregation_to_equal_other_table(df: DataFrame, expression, compare_df: DataFrame, **options) -> DataFrame:
    """Fails where an aggregate differs between the tables."""
    return equal_expression(df, expression, compare_df, **options)


def expect_table_row_count_to_equal_other_table(
    df: DataFrame, compare_df: DataFrame, group_by=None, compare_group_by=None, factor: float = 1,
    row_condition=None, compare_row_condition=None,
) -> DataFrame:
    """Fails where the row count is not ``factor`` times the other table's."""
    rows = F.count(F.lit(1))
    return equal_expression(
        df, rows, compare_df, rows * factor, group_by, compare_group_by, row_condition, compare_row_condition
    )


def expect_table_row_count_to_equal_other_table_times_factor(
    df: DataFrame, compare_df: DataFrame, factor: float, **options
) -> DataFrame:
    """The same check with the factor required."""
    return expect_table_row_count_to_equal_other_table(df, compare_df, factor=factor, **options)


def expect_column_distinct_count_to_equal_other_table(
    df: DataFrame, column: str, compare_df: DataFrame | None = None, compare_column: str | None = None,
    row_condition=None, compare_row_condition=None,
) -> DataFrame:
    """Fails when the columns have different numbers of distinct values."""
    return equal_expression(
        df,
        F.countDistinct(as_column(column)),
        compare_df,
        F.countDistinct(as_column(compare_column or column)),
        row_condition=row_condition,
        compare_row_condition=compare_row_condition,
    )


# --- freshness ---------------------------------------------------------------------------


def expect_row_values_to_have_recent_data(
    df: DataFrame, column: str, datepart: str, interval: int, row_condition=None, tz: str = "UTC",
    as_of: Column | None = None,
) -> DataFrame:
    """Fails when the latest moment that is not in the future lies before now minus the
    interval. A table without rows counts as last filled in 1970."""
    moment, now = as_column(column).cast(d.NTZ), d.now(tz, as_of)
    latest = where(df, row_condition).filter(moment <= now).agg(F.max(moment).alias("max_timestamp"))
    oldest = F.lit("1970-01-01 00:00:00").cast(d.NTZ)
    return latest.filter(F.coalesce("max_timestamp", oldest) < d.add_parts(datepart, -interval, now))


def expect_grouped_row_values_to_have_recent_data(
    df: DataFrame, timestamp_column: str, datepart: str, interval: int, group_by: Sequence[str] | None = None,
    row_condition=None, tz: str = "UTC", as_of: Column | None = None,
) -> DataFrame:
    """Fails for each group whose latest moment lies before now minus the interval.

    Groups with a NULL key are not reported. Without ``group_by`` the table is one group.
    """
    groups = list(group_by or ())
    moment, now = as_column(timestamp_column).cast(d.NTZ), d.now(tz, as_of)
    rows = where(df, row_condition).filter(moment <= now)
    latest = F.max(moment).alias("latest_timestamp_column")
    grouped = rows.groupBy(*groups).agg(latest) if groups else rows.agg(latest)
    for g in groups:
        grouped = grouped.filter(F.col(g).isNotNull())
    late = grouped.filter(F.col("latest_timestamp_column") < d.add_parts(datepart, -interval, now))
    return late.select(
        F.lit(1).cast("bigint").alias("row_count"), *groups, F.lit(1).alias("join_key"), "latest_timestamp_column"
    )


__all__ = [name for name in list(globals()) if name.startswith("expect_")]
