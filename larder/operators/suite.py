"""Running many expectations: one row per check with failures and status.

One scan per table answers all checks that state a predicate about rows or about the table, and all that ask about
distinct values: uniqueness, counts of distinct values, and how they meet a list. A row is unfolded into itself and one
(check, value) pair for each check of the second kind; equal pairs are folded before the one shuffle, and counts per
check follow from the folded pairs. Checks of other kinds run as their own small aggregation.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators import expectations
from larder.operators.expectations import PREDICATES, Predicate, as_column
from larder.operators.expectations.core import bounds_hold

_COMPARE = {
    "=": operator.eq, "==": operator.eq, "!=": operator.ne, "<>": operator.ne,
    ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
}
COUNT_ROWS = "count(*)"


@dataclass(frozen=True)
class Check:
    """One expectation on one table.

    ``fail_calc`` turns the failing rows into a number, which ``error_if`` and ``warn_if``
    judge. With severity ``warn`` a check never errors.
    """

    table: str
    expectation: str
    args: dict = field(default_factory=dict)
    severity: str = "error"
    error_if: str = "!= 0"
    warn_if: str = "!= 0"
    fail_calc: str = COUNT_ROWS
    name: str | None = None

    @property
    def label(self) -> str:
        column = self.args.get("column")
        return self.name or (f"{self.expectation}({column})" if column else self.expectation)


def meets(value: Column, condition: str) -> Column:
    """A threshold such as ``>10`` or ``!= 0`` applied to a number."""
    found = re.fullmatch(r"\s*(==?|!=|<>|>=|<=|>|<)\s*(-?\d+(?:\.\d+)?)\s*", condition)
    if not found:
        raise ValueError(f"not a threshold: {condition!r}")
    return _COMPARE[found[1]](value, F.lit(float(found[2])))


def _status(check: Check, failures: Column) -> Column:
    warned = F.when(meets(failures, check.warn_if), "warn").otherwise("pass")
    if check.severity == "warn":
        return warned
    return F.when(meets(failures, check.error_if), "fail").otherwise(warned)


def _fused(check: Check) -> Column | None:
    """The number of failures as an aggregate over the table, where that is possible."""
    build = PREDICATES.get({"not_null": "expect_column_values_to_not_be_null"}.get(check.expectation, check.expectation))
    if build is None or check.fail_calc != COUNT_ROWS:
        return None
    predicate: Predicate | None = build(**check.args)
    if predicate is None or predicate.group_by or (predicate.aggregate and predicate.row_condition is not None):
        return None
    fails = predicate.fails
    if predicate.aggregate:
        return F.when(fails, 1).otherwise(0).cast("bigint")
    if predicate.row_condition is not None:
        fails = as_column(predicate.row_condition) & fails
    return F.count(F.when(fails, 1))


@dataclass(frozen=True)
class _Distinct:
    """A question about the distinct values of a key: the rows that it looks at, and the failures over ``_suite_n`` (rows of the value) and ``_suite_value``."""

    key: tuple[Column, ...]
    rows: Column
    failures: Column


def _as_text(df: DataFrame, key: tuple[Column, ...]) -> Column:
    """The key as text, equal keys alike: 0.0 and -0.0 are, and missing parts of several."""
    kinds = df.select(*(c.alias(f"c{k}") for k, c in enumerate(key))).schema
    texts = []
    for column, f in zip(key, kinds):
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            column = column + F.lit(0.0).cast(f.dataType)
        texts.append(column.cast("string") if isinstance(f.dataType, T.AtomicType) else F.to_json(column))
    return texts[0] if len(texts) == 1 else F.to_json(F.struct(*(t.alias(f"c{k}") for k, t in enumerate(texts))))


def _met_twice() -> Column:
    return F.count(F.when(F.col("_suite_n") > 1, 1))


def _number_check(holds) -> Column:
    """One failure if the number of distinct values does not meet the check."""
    return F.when(~(holds == F.lit(True)), 1).otherwise(0).cast("bigint")


def _repeated(column: str, row_condition=None) -> _Distinct:
    return _Distinct((as_column(column),), _holds(row_condition) & as_column(column).isNotNull(), _met_twice())


def _repeated_record(column_list, quote_columns=False, ignore_row_if_mode="all_values_are_missing", row_condition=None) -> _Distinct:
    names = [f"`{c}`" if quote_columns else c for c in column_list]
    kept = _holds(row_condition) & expectations.ignore_row_if(ignore_row_if_mode, names)
    return _Distinct(tuple(map(as_column, names)), kept, _met_twice())


def _counted(compare):
    def build(column, value, group_by=None, row_condition=None) -> _Distinct | None:
        if group_by:
            return None
        return _Distinct((as_column(column),), _holds(row_condition), _number_check(compare(F.count("_suite_value"), F.lit(value))))

    return build


def _counted_between(share: bool):
    def build(column, min_value=None, max_value=None, group_by=None, row_condition=None, strictly=False) -> _Distinct | None:
        if group_by:
            return None
        number = F.count("_suite_value")
        if share:
            number = F.try_divide(number.cast("double"), F.sum(F.when(F.col("_suite_value").isNotNull(), F.col("_suite_n"))))
        holds = bounds_hold(number, min_value, max_value, strictly)
        return _Distinct((as_column(column),), _holds(row_condition), _number_check(holds))

    return build


def _listed(extra: bool, missing: bool):
    def build(column, value_set, quote_values=True, row_condition=None) -> _Distinct | None:
        if not quote_values:
            return None
        wanted = sorted({str(v) for v in value_set})
        found = F.col("_suite_value").isin(*wanted)
        outside = F.count(F.when((F.col("_suite_n") > 0) & ~F.coalesce(found, F.lit(False)), 1))
        absent = F.lit(len(wanted)) - F.count(F.when(found, 1))
        failures = outside + absent if extra and missing else outside if extra else absent
        return _Distinct((as_column(column).cast("string"),), _holds(row_condition), failures.cast("bigint"))

    return build


#: What is answered from the distinct values of a key.
DISTINCT = {
    "unique": _repeated,
    "expect_column_values_to_be_unique": _repeated,
    "expect_compound_columns_to_be_unique": _repeated_record,
    "expect_column_distinct_count_to_equal": _counted(operator.eq),
    "expect_column_distinct_count_to_be_greater_than": _counted(operator.gt),
    "expect_column_distinct_count_to_be_less_than": _counted(operator.lt),
    "expect_column_unique_value_count_to_be_between": _counted_between(share=False),
    "expect_column_proportion_of_unique_values_to_be_between": _counted_between(share=True),
    "expect_column_distinct_values_to_be_in_set": _listed(extra=True, missing=False),
    "expect_column_distinct_values_to_contain_set": _listed(extra=False, missing=True),
    "expect_column_distinct_values_to_equal_set": _listed(extra=True, missing=True),
}


def _holds(row_condition) -> Column:
    return F.lit(True) if row_condition is None else F.coalesce(as_column(row_condition), F.lit(False))


def _answers(df: DataFrame, fused: dict[int, Column], distinct: dict[int, _Distinct]) -> DataFrame:
    """One row with a column ``c<i>`` for every check."""
    if not distinct:
        return df.agg(*(count.alias(f"c{i}") for i, count in fused.items()))
    # The row itself carries no value; its own columns are there for the predicates only.
    pairs = [F.struct(F.lit(-1).alias("check"), F.lit(None).cast("string").alias("value"))]
    pairs += [F.when(d.rows, F.struct(F.lit(i).alias("check"), _as_text(df, d.key).alias("value"))) for i, d in distinct.items()]
    pair = F.explode(F.array_compact(F.array(*pairs))).alias("_suite_pair")
    unfolded = df.select("*", pair).select("*", F.col("_suite_pair.check").alias("_suite_check"), F.col("_suite_pair.value").alias("_suite_value"))
    folded = unfolded.groupBy("_suite_check", "_suite_value").agg(F.count(F.lit(1)).alias("_suite_n"), *(count.alias(f"c{i}") for i, count in fused.items()))
    own = [F.max(f"c{i}").alias(f"c{i}") for i in fused]
    per_check = folded.groupBy("_suite_check").agg(*(d.failures.alias(f"c{i}") for i, d in distinct.items()), *own)
    # One row per check now. A check that no row reaches has its answer over no value at all.
    nothing = per_check.sparkSession.range(1).select(F.lit(None).cast("string").alias("_suite_value"), F.lit(None).cast("long").alias("_suite_n")).filter("_suite_n > 0")
    blank = nothing.agg(*(d.failures.alias(f"b{i}") for i, d in distinct.items()))
    picked = per_check.agg(
        *(F.max(F.when(F.col("_suite_check") == i, F.col(f"c{i}"))).alias(f"c{i}") for i in distinct),
        *(F.max(F.when(F.col("_suite_check") == -1, F.col(f"c{i}"))).alias(f"c{i}") for i in fused),
    )
    zero = df.limit(0).agg(*(count.alias(f"z{i}") for i, count in fused.items())) if fused else None
    columns = [F.coalesce(F.col(f"c{i}"), blank.select(f"b{i}").scalar()).alias(f"c{i}") for i in distinct]
    columns += [F.coalesce(F.col(f"c{i}"), zero.select(f"z{i}").scalar()).alias(f"c{i}") for i in fused]
    return picked.select(*columns)


def run_suite(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Results as ``position, table_name, check_name, failures, status``."""
    fused: dict[str, dict[int, Column]] = {}
    distinct: dict[str, dict[int, _Distinct]] = {}
    frames: list[DataFrame] = []
    for i, check in enumerate(checks):
        asked = DISTINCT[check.expectation](**check.args) if check.expectation in DISTINCT and check.fail_calc == COUNT_ROWS else None
        if asked is not None:
            distinct.setdefault(check.table, {})[i] = asked
            continue
        count = _fused(check)
        if count is not None:
            fused.setdefault(check.table, {})[i] = count
            continue
        run = getattr(expectations, check.expectation)
        failures = run(tables[check.table], **check.args).agg(F.expr(check.fail_calc).cast("bigint").alias("failures"))
        frames.append(_result(failures, i, check))
    for table in dict.fromkeys([*fused, *distinct]):
        members = sorted([*fused.get(table, ()), *distinct.get(table, ())])
        counts = _answers(tables[table], fused.get(table, {}), distinct.get(table, {}))
        rows = F.array(
            *(
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(table).alias("table_name"),
                    F.lit(checks[i].label).alias("check_name"),
                    F.col(f"c{i}").alias("failures"),
                    _status(checks[i], F.col(f"c{i}")).alias("status"),
                )
                for i in members
            )
        )
        frames.append(counts.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, frames)


def _result(failures: DataFrame, position: int, check: Check) -> DataFrame:
    return failures.select(
        F.lit(position).alias("position"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.label).alias("check_name"),
        "failures",
        _status(check, F.col("failures")).alias("status"),
    )
