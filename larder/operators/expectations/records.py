"""Uniqueness of keys and of values within a record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.expectations.core import as_column, ignore_row_if, where
from larder.operators.sweep import swept

__all__ = [
    "expect_column_values_to_be_unique",
    "expect_compound_columns_to_be_unique",
    "expect_select_column_values_to_be_unique_within_record",
    "not_null",
    "unique",
]


def _column_names(columns: Sequence[str], quote_columns: bool) -> list[str]:
    if quote_columns not in (True, False):
        raise ValueError(f"`quote_columns` must be True or False, not {quote_columns!r}")
    return [f"`{c}`" for c in columns] if quote_columns else list(columns)


#: Hashes met twice that are broadcast; with more of them, keys are counted as they are.
FEW_HASHES = 100_000


def _repeated(rows: DataFrame, keys: list[Column]) -> DataFrame:
    """Keys that occur more than once, with ``n_records``.

    Hashes of the keys are counted first: a table whose key is unique shuffles eight bytes a row and its keys not at all.
    Only rows whose hash was met twice are then counted by their whole keys, so that different keys of one hash stay
    apart. Runs a job when called.
    """
    hashed = rows.select(_hash(keys).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    twice = hashed.select("_hash").limit(FEW_HASHES + 1).collect()
    if not twice:
        rows = rows.limit(0)
    elif len(twice) <= FEW_HASHES:
        met = rows.sparkSession.createDataFrame(twice, "_hash long")
        rows = rows.join(F.broadcast(met), _hash(keys) == F.col("_hash"), "left_semi")
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def _hash(keys: list[Column]) -> Column:
    """Equal keys have equal hashes: NULL is a value, 0.0 and -0.0 are one."""
    return F.xxhash64(*keys)


def expect_compound_columns_to_be_unique(
    df: DataFrame,
    column_list: Sequence[str],
    quote_columns: bool = False,
    ignore_row_if_mode: str = "all_values_are_missing",
    row_condition=None,
) -> DataFrame:
    """Fails for each key that occurs more than once, with ``n_records``."""
    if not column_list or isinstance(column_list, str):
        raise ValueError(f"`column_list` must be a list of columns, got {column_list!r}")
    names = _column_names(column_list, quote_columns)
    rows = where(df, row_condition).filter(ignore_row_if(ignore_row_if_mode, names))
    return _repeated(rows, [as_column(n).alias(c) for n, c in zip(names, column_list)])


def expect_column_values_to_be_unique(df: DataFrame, column: str, row_condition=None) -> DataFrame:
    """Fails for each present value that occurs more than once."""
    return expect_compound_columns_to_be_unique(df, [column], row_condition=row_condition)


def expect_select_column_values_to_be_unique_within_record(
    df: DataFrame,
    column_list: Sequence[str],
    quote_columns: bool = False,
    ignore_row_if_mode: str = "all_values_are_missing",
    row_condition=None,
) -> DataFrame:
    """Fails for each row with fewer distinct values than columns.

    Values are compared as text; a missing value is none, so a partly empty row fails.
    ``row_index`` is the row's position in the table ordered by the columns.
    """
    names = _column_names(column_list, quote_columns)
    rows = where(df, row_condition).filter(ignore_row_if(ignore_row_if_mode, names))
    columns = [f"_c{i}" for i in range(len(names))]
    placed = swept(rows.select(*(as_column(n).alias(c) for n, c in zip(names, columns))), [], columns, position="row_index")
    texts = F.array(*(F.col(c).cast("string") for c in columns))
    distinct = F.size(F.array_distinct(F.array_compact(texts))).cast("bigint").alias("column_values")
    return placed.select("row_index", distinct).filter(F.col("column_values") < len(names))


def not_null(df: DataFrame, column: str, row_condition=None) -> DataFrame:
    """The rows whose column is missing."""
    return where(df, row_condition).filter(as_column(column).isNull())


def unique(df: DataFrame, column: str, row_condition=None) -> DataFrame:
    """Present values occurring more than once, as ``unique_field`` and ``n_records``."""
    rows = where(df, row_condition).filter(as_column(column).isNotNull())
    return _repeated(rows, [as_column(column).alias("unique_field")])
