"""Expectations on small literal tables: cases that pass and cases that must fail."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.operators import expectations as e
from larder.operators.ordered import running_sum
from larder.operators.suite import Check, run_suite

DATA = [
    (1, "2020-10-21", 0.0, 1.0, "a", "b"),
    (2, "2020-10-22", 1.0, 0.0, "b", "ab"),
    (3, "2020-10-23", 0.5, 0.5, "c", "abc"),
    (4, "2020-10-23", 0.5, 0.5, "c", "abcd"),
]
COLUMNS = [
    "idx", "date_col", "col_numeric_a", "col_numeric_b", "col_string_a", "col_string_b", "col_null", "col_null_2",
    "col_numeric_a_plus_b", "idx_multiplied_by_2", "idx_multiplied_by_minus_2",
]
A, B = "col_numeric_a", "col_numeric_b"


@pytest.fixture(scope="module")
def data(spark):
    df = spark.createDataFrame(DATA, f"idx int, date_col string, {A} double, {B} double, col_string_a string, col_string_b string")
    nothing = F.lit(None).cast("string")
    return df.select(
        "*",
        nothing.alias("col_null"),
        nothing.alias("col_null_2"),
        (F.col(A) + F.col(B)).alias("col_numeric_a_plus_b"),
        (F.col("idx") * 2).alias("idx_multiplied_by_2"),
        (F.col("idx") * -2).alias("idx_multiplied_by_minus_2"),
    ).cache()


@pytest.fixture(scope="module")
def factored(spark, data):
    return data.withColumn("factor", F.explode(F.array(F.lit(1), F.lit(2))))


@pytest.fixture(scope="module")
def text(spark):
    rows = [
        ("ab@gmail.com", "91001", "91001-123"),
        ("ab@mail.com", "90210", "90210-123"),
        ("abc@gmail.com", "90026", "90026-123"),
        ("abc.com@gmail.com", "09876", "09876-023"),
    ]
    return spark.createDataFrame(rows, "email_address string, postal_code_5 string, postal_code_5_3 string").cache()


MAIL, DIGITS = "email_address", r"^\d{5}"

# (check, arguments, number of failures)
TEXT = [
    (e.expect_column_values_to_match_regex, (MAIL, "@[^.]*"), {}, 0),
    (e.expect_column_values_to_match_regex, (MAIL, "&[^.]*"), {}, 4),
    (e.expect_column_values_to_match_regex, (MAIL, "[A-Z]"), {"flags": "i"}, 0),
    (e.expect_column_values_to_match_regex, (MAIL, "[A-Z]"), {"flags": "c"}, 4),
    (e.expect_column_values_to_not_match_regex, (MAIL, "&[^.]*"), {}, 0),
    (e.expect_column_values_to_not_match_regex, (MAIL, "@[^.]*"), {}, 4),
    (e.expect_column_values_to_not_match_regex, (MAIL, "[A-Z]"), {}, 0),
    (e.expect_column_values_to_not_match_regex, (MAIL, "[a-z]"), {}, 4),
    (e.expect_column_values_to_match_regex_list, (MAIL, ["@[^.]*", "&[^.]*"]), {}, 0),
    (e.expect_column_values_to_match_regex_list, (MAIL, ["#[^.]*", "&[^.]*"]), {}, 4),
    (e.expect_column_values_to_match_regex_list, (MAIL, ["[A-G]", "[H-Z]"]), {"flags": "i"}, 0),
    (e.expect_column_values_to_match_regex_list, (MAIL, ["[A-G]", "[H-Z]"]), {"flags": "c"}, 4),
    (e.expect_column_values_to_not_match_regex_list, (MAIL, ["@[^.]*", "&[^.]*"]), {}, 0),
    (e.expect_column_values_to_not_match_regex_list, (MAIL, ["@[^.]*", "@[^.]*"]), {}, 4),
    (e.expect_column_values_to_not_match_regex_list, (MAIL, ["&[^.]*", "&[^.]*"]), {"match_on": "all"}, 0),
    (e.expect_column_values_to_not_match_regex_list, (MAIL, ["@[^.]*", "&[^.]*"]), {"match_on": "all"}, 4),
    (e.expect_column_values_to_not_match_regex_list, (MAIL, ["[A-Z]", "[0-9]"]), {"flags": "i"}, 0),
    (e.expect_column_values_to_not_match_regex_list, (MAIL, ["[A-Z]", "[0-9]"]), {"flags": "i", "match_on": "all"}, 4),
    (e.expect_column_values_to_match_like_pattern, (MAIL, "%@%"), {}, 0),
    (e.expect_column_values_to_match_like_pattern, (MAIL, "%&%"), {}, 4),
    (e.expect_column_values_to_not_match_like_pattern, (MAIL, "%&%"), {}, 0),
    (e.expect_column_values_to_not_match_like_pattern, (MAIL, "%@%"), {}, 4),
    (e.expect_column_values_to_match_like_pattern_list, (MAIL, ["%@%", "%&%"]), {}, 0),
    (e.expect_column_values_to_match_like_pattern_list, (MAIL, ["%@%", "%&%"]), {"match_on": "all"}, 4),
    (e.expect_column_values_to_not_match_like_pattern_list, (MAIL, ["%@%", "%&%"]), {}, 0),
    (e.expect_column_values_to_not_match_like_pattern_list, (MAIL, ["%@%", "%&%"]), {"match_on": "all"}, 4),
    (e.expect_column_values_to_match_regex, ("postal_code_5", DIGITS), {"is_raw": True}, 0),
    (e.expect_column_values_to_match_regex, ("postal_code_5", r"^\d{55}"), {"is_raw": True}, 4),
    (e.expect_column_values_to_match_regex_list, ("postal_code_5", [DIGITS, "@[^.]*"]), {"match_on": "all"}, 4),
    (e.expect_column_values_to_match_regex, ("postal_code_5_3", r"^\d{5}-\d{3}"), {}, 0),
    (e.expect_column_values_to_match_regex, ("postal_code_5_3", r"^\d{5}-\d{9}"), {}, 4),
]


@pytest.mark.parametrize("check, args, options, failures", TEXT)
def test_text_patterns(text, check, args, options, failures):
    assert check(text, *args, **options).count() == failures


TABLE = [
    (e.expression_is_true, (f"{A} + {B} = 1",), {}, 0),
    (e.expression_is_true, (f"{A} > {B}",), {}, 3),
    (e.expression_is_true, ("count(*) < 2",), {"group_by": ["date_col"]}, 1),
    (e.expression_is_true, ("count(*) > 4",), {"aggregate": True}, 1),
    (e.expression_between, (A, 0, 1), {"strictly": True}, 2),
    (e.equal_expression, (f"sum({A})",), {"group_by": ["idx"]}, 0),
    (e.equal_expression, (f"sum({A})",), {"compare_expression": f"sum({A} * .5)", "group_by": ["idx"], "tolerance_percent": 0.5}, 0),
    (e.equal_expression, (f"sum({A})",), {"compare_expression": f"sum({A} * .5)", "group_by": ["idx"], "tolerance_percent": 0.4}, 3),
    (e.equal_expression, (f"sum({A})",), {"compare_expression": f"sum({B})"}, 0),
    (e.equal_expression, (f"sum({A})",), {"compare_expression": f"sum({A}) + 1"}, 1),
    (e.equal_expression, (f"sum({A})",), {"compare_expression": f"sum({A}) + 1", "tolerance": 1.0}, 0),
    # a percentage of 0 is none, so the absolute tolerance counts
    (e.equal_expression, (f"sum({A})",), {"compare_expression": f"sum({A}) + 1", "tolerance": 2.0, "tolerance_percent": 0}, 0),
    (e.expect_compound_columns_to_be_unique, (["date_col", "col_string_b"],), {}, 0),
    (e.expect_compound_columns_to_be_unique, (["date_col", "col_null"],), {"ignore_row_if_mode": "any_value_is_missing"}, 0),
    (e.expect_compound_columns_to_be_unique, (["date_col", "col_null"],), {}, 1),
    (e.expect_compound_columns_to_be_unique, (["col_null", "col_null_2"],), {}, 0),
    (e.expect_compound_columns_to_be_unique, (["date_col"],), {"row_condition": "idx < 4", "quote_columns": True}, 0),
    (e.expect_table_row_count_to_equal, (4,), {}, 0),
    (e.expect_table_row_count_to_equal, (5,), {}, 1),
    (e.expect_table_row_count_to_be_between, (1, 4), {}, 0),
    (e.expect_table_row_count_to_be_between, (1,), {}, 0),
    (e.expect_table_row_count_to_be_between, (), {"max_value": 4}, 0),
    (e.expect_table_row_count_to_be_between, (), {"max_value": 4, "strictly": True}, 1),
    (e.expect_table_row_count_to_be_between, (2,), {"group_by": ["date_col"]}, 2),
    (e.expect_table_column_count_to_equal, (11,), {}, 0),
    (e.expect_table_column_count_to_equal, (10,), {}, 1),
    (e.expect_table_column_count_to_be_between, (1, 11), {}, 0),
    (e.expect_table_column_count_to_be_between, (12, 20), {}, 1),
    # a bound of 0 is not looked at
    (e.expect_table_column_count_to_be_between, (1, 0), {}, 0),
    (e.expect_table_columns_to_contain_set, ([B, "COL_STRING_A"],), {}, 0),
    (e.expect_table_columns_to_contain_set, (["nothing"],), {}, 1),
    (e.expect_table_columns_to_match_set, (list(reversed(COLUMNS)),), {}, 0),
    (e.expect_table_columns_to_match_set, (COLUMNS[1:] + ["extra"],), {}, 2),
    (e.expect_table_columns_to_match_ordered_list, (COLUMNS,), {}, 0),
    (e.expect_table_columns_to_match_ordered_list, (COLUMNS[1:],), {}, 21),
    (e.expect_table_columns_to_not_contain_set, (["col_numeric_c"],), {}, 0),
    (e.expect_table_columns_to_not_contain_set, (["IDX"],), {}, 1),
    (e.expect_column_to_exist, ("idx", 1), {}, 0),
    (e.expect_column_to_exist, (A, 3), {}, 0),
    (e.expect_column_to_exist, (A, 2), {}, 1),
    (e.expect_column_to_exist, (A, 0), {}, 0),
    (e.expect_column_to_exist, ("IDX",), {}, 0),
    (e.expect_column_to_exist, ("IDX",), {"transform": "none"}, 1),
    (e.expect_column_values_to_be_of_type, ("idx", "integer"), {}, 0),
    (e.expect_column_values_to_be_of_type, ("date_col", "varchar"), {}, 0),
    (e.expect_column_values_to_be_in_type_list, ("idx", ["date", "bigint"]), {}, 1),
    (e.expect_column_values_to_be_in_type_list, ("absent", ["date"]), {}, 0),
    (e.expect_column_pair_values_to_be_in_set, (A, B, [[0, 1], [1, 0], [0.5, 0.5]]), {}, 0),
    (e.expect_column_pair_values_to_be_in_set, (A, B, [[0, 1], [1, 0]]), {}, 2),
    (e.expect_column_pair_values_A_to_be_greater_than_B, (f"{A}+10", A), {}, 0),
    (e.expect_column_pair_values_A_to_be_greater_than_B, (A, A), {}, 4),
    (e.expect_column_pair_values_A_to_be_greater_than_B, (A, A), {"or_equal": True}, 0),
    (e.expect_column_pair_values_to_be_equal, (A, A), {}, 0),
    (e.expect_column_pair_values_to_be_equal, (A, B), {}, 2),
    (e.expect_select_column_values_to_be_unique_within_record, (["col_string_a", "col_string_b"],), {"ignore_row_if_mode": "any_value_is_missing"}, 0),
    (e.expect_select_column_values_to_be_unique_within_record, ([A, B],), {}, 2),
    (e.expect_select_column_values_to_be_unique_within_record, (["idx", "col_null"],), {}, 4),
    (e.expect_multicolumn_sum_to_equal, ([A, B], 4), {}, 0),
    (e.expect_multicolumn_sum_to_equal, ([A, B], 5), {}, 1),
    (e.expect_multicolumn_sum_to_equal, ([A, B], "col_numeric_a_plus_b"), {"group_by": ["idx"]}, 0),
    (e.expect_column_values_to_be_unique, ("idx",), {}, 0),
    (e.expect_column_values_to_be_unique, (A,), {}, 1),
    (e.expect_column_values_to_be_increasing, ("idx", "idx"), {}, 0),
    (e.expect_column_values_to_be_increasing, (A, A), {"strictly": False}, 0),
    (e.expect_column_values_to_be_increasing, (A, A), {}, 1),
    (e.expect_column_values_to_be_increasing, ("idx_multiplied_by_2", "idx"), {"step": 2}, 0),
    (e.expect_column_values_to_be_increasing, ("idx_multiplied_by_2", "idx"), {"step": 1}, 3),
    (e.expect_column_values_to_be_decreasing, ("idx_multiplied_by_minus_2", "idx"), {"step": 2}, 0),
    (e.expect_column_values_to_be_decreasing, ("idx", "idx"), {}, 3),
    (e.expect_column_values_to_not_be_null, (A,), {}, 0),
    (e.expect_column_values_to_not_be_null, ("col_null",), {}, 4),
    (e.expect_column_values_to_be_null, ("col_null",), {}, 0),
    (e.expect_column_values_to_be_between, (A, 0, 1), {}, 0),
    (e.expect_column_values_to_be_between, ("cast(col_null as int)", 0, 1), {}, 0),
    (e.expect_column_sum_to_be_between, (A, 1, 3), {}, 0),
    (e.expect_column_sum_to_be_between, (A, 3), {}, 1),
    (e.expect_column_min_to_be_between, (A, 0, 0), {}, 0),
    (e.expect_column_max_to_be_between, (A, 1, 1), {}, 0),
    (e.expect_column_max_to_be_between, (A, 0, 0.5), {"group_by": ["date_col"]}, 1),
    (e.expect_column_mean_to_be_between, (A, 0, 1.5), {}, 0),
    (e.expect_column_median_to_be_between, (A, 0.5, 0.5), {}, 0),
    (e.expect_column_median_to_be_between, (A, 0.6), {}, 1),
    (e.expect_column_quantile_values_to_be_between, (A, 0.95, 0.9, 1), {}, 0),
    (e.expect_column_unique_value_count_to_be_between, (A, 3, 3), {}, 0),
    (e.expect_column_proportion_of_unique_values_to_be_between, (A, 0, 0.75), {}, 0),
    (e.expect_column_proportion_of_unique_values_to_be_between, ("col_null", 0, 0.75), {}, 0),
    (e.expect_column_stdev_to_be_between, (A, 0, 2), {}, 0),
    (e.expect_column_stdev_to_be_between, (A, 0), {"strictly": True}, 0),
    (e.expect_column_distinct_count_to_be_less_than, ("col_string_a", 4), {}, 0),
    (e.expect_column_distinct_count_to_be_greater_than, ("col_string_a", 3), {}, 1),
    (e.expect_column_distinct_count_to_equal, ("col_string_a", 1), {"group_by": ["date_col"]}, 0),
    (e.expect_column_most_common_value_to_be_in_set, (A, [0.5], 1), {"quote_values": False}, 0),
    (e.expect_column_most_common_value_to_be_in_set, (A, [0.5], 2), {"quote_values": False}, 1),
    (e.expect_column_most_common_value_to_be_in_set, ("col_string_a", ["x"], 9), {}, 0),
    (e.expect_column_values_to_be_in_set, ("col_string_a", ["a", "b", "c"]), {}, 0),
    (e.expect_column_values_to_be_in_set, ("col_null", ["a"]), {}, 4),
    (e.expect_column_values_to_not_be_in_set, ("col_string_a", ["2", "3"]), {}, 0),
    (e.expect_column_values_to_not_be_in_set, ("col_string_a", ["c", "c"]), {}, 4),
    (e.expect_column_values_to_not_be_in_set, ("col_null", ["a"]), {}, 0),
    (e.expect_column_distinct_values_to_equal_set, ("col_string_a", ["a", "b", "c", "c"]), {}, 0),
    (e.expect_column_distinct_values_to_equal_set, ("col_string_a", ["a", "b", "x"]), {}, 2),
    (e.expect_column_distinct_values_to_be_in_set, ("col_string_a", ["a", "b", "c", "d"]), {}, 0),
    (e.expect_column_distinct_values_to_be_in_set, ("col_string_a", ["a", "b"]), {}, 1),
    (e.expect_column_distinct_values_to_contain_set, ("col_string_a", ["a", "b"]), {}, 0),
    (e.expect_column_distinct_values_to_contain_set, ("col_string_a", ["a", "z", "z"]), {}, 1),
    (e.expect_column_value_lengths_to_equal, ("col_string_a", 1), {}, 0),
    (e.expect_column_value_lengths_to_be_between, ("col_string_b", 1, 4), {}, 0),
    (e.expect_column_value_lengths_to_be_between, ("col_string_b", 2), {}, 1),
    (e.expect_column_values_to_have_consistent_casing, ("col_string_a",), {}, 0),
    # one missing value is counted on one side only
    (e.expect_column_values_to_have_consistent_casing, ("col_null",), {}, 1),
    (e.expect_column_values_to_have_consistent_casing, ("if(idx = 1, 'C', col_string_a)", True), {}, 1),
    (e.not_null, ("col_null",), {}, 4),
    (e.unique, ("date_col",), {}, 1),
    (e.expect_column_values_to_be_within_n_stdevs, (A,), {}, 0),
    (e.expect_column_values_to_be_within_n_stdevs, (A,), {"group_by": ["idx"], "sigma_threshold": 1}, 2),
]


@pytest.mark.parametrize("check, args, options, failures", TABLE)
def test_table_checks(data, check, args, options, failures):
    assert check(data, *args, **options).count() == failures


def test_other_table(data, factored):
    e3 = e.expect_table_row_count_to_equal_other_table_times_factor
    for keys in (None, ["date_col"], ["date_col", "idx"]):
        assert e3(factored, data, 2, group_by=keys).isEmpty()
        assert not e3(factored, data, 3, group_by=keys).isEmpty()
    assert e.expect_table_row_count_to_equal_other_table(data, data, row_condition="1=1", compare_row_condition="1=1").isEmpty()
    assert e.expect_table_column_count_to_equal_other_table(data, data).isEmpty()
    assert e.expect_table_column_count_to_equal_other_table(data, factored).count() == 1
    assert e.expect_column_distinct_count_to_equal_other_table(data, "idx", factored).isEmpty()
    assert e.expect_table_aggregation_to_equal_other_table(
        data, f"sum({A})", data, compare_expression=f"sum({A} * .99)", group_by=["idx"], tolerance_percent=0.95
    ).isEmpty()


def test_rolling_sums_are_monotone(spark):
    rows = [(1, "2020-10-21", 0.5), (1, "2020-10-22", 1.0), (2, "2020-10-21", 0.5), (2, "2020-10-22", 1.0), (3, "2020-10-23", 0.5), (4, "2020-10-23", 0.5)]
    df = spark.createDataFrame(rows, "idx int, date_col string, x double")
    up = running_sum(df, "x", ["idx"], "date_col", "up")
    both = running_sum(up, "x", ["idx"], "date_col", "down", descending=True)
    assert {(r.idx, r.up, r.down) for r in both.filter("idx = 1").collect()} == {(1, 0.5, 1.5), (1, 1.5, 1.0)}
    assert e.expect_column_values_to_be_increasing(both, "up", "date_col", group_by=["idx"]).isEmpty()
    assert e.expect_column_values_to_be_decreasing(both, "down", "date_col", group_by=["idx"]).isEmpty()


def test_wrong_arguments(data):
    for call in (
        lambda: e.expression_between(data, A),
        lambda: e.expect_table_column_count_to_be_between(data),
        lambda: e.expect_compound_columns_to_be_unique(data, []),
        lambda: e.expect_compound_columns_to_be_unique(data, ["idx"], quote_columns="maybe"),
        lambda: e.expect_column_pair_values_to_be_in_set(data, A, B, [[1, 2, 3]]),
        lambda: e.ignore_row_if("sometimes", ["idx"]),
    ):
        with pytest.raises(ValueError):
            call()
    with pytest.warns(UserWarning, match="flags"):
        e.expect_column_values_to_match_regex(data, "col_string_a", "a", flags="z")


# --- time ------------------------------------------------------------------------------

NOW = dt.datetime(2024, 3, 15, 12)


def as_of():
    return F.lit(str(NOW)).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def series(spark):
    """A year of days up to yesterday in four groups; group 4 stops early, one day is a spike."""
    rows = []
    for back in range(1, 367):
        day = dt.datetime(2024, 3, 15) - dt.timedelta(days=back)
        for group in (1, 2, 3, 4):
            if group == 4 and back < 10:
                continue
            wave = 50 + 10 * ((back * 7 + group) % 5)
            rows.append((day, group, 5000.0 if (back, group) == (3, 2) else float(wave)))
    return spark.createDataFrame(rows, "date_day timestamp_ntz, group_id int, row_value double").cache()


def test_recent_data(series):
    recent = e.expect_row_values_to_have_recent_data
    assert recent(series, "date_day", "day", 2, as_of=as_of()).isEmpty()
    assert recent(series, "date_day", "hour", 24, as_of=as_of()).count() == 1
    assert recent(series, "date_day", "day", 2, row_condition="group_id = 4", as_of=as_of()).count() == 1
    assert recent(series, "date_day", "day", 2, row_condition="group_id = 9", as_of=as_of()).count() == 1
    grouped = e.expect_grouped_row_values_to_have_recent_data
    late = grouped(series, "date_day", "day", 2, group_by=["group_id"], as_of=as_of()).collect()
    assert [(r.group_id, r.row_count, r.join_key) for r in late] == [(4, 1, 1)]
    assert grouped(series, "date_day", "day", 2, as_of=as_of()).isEmpty()
    assert grouped(series, "date_day", "day", 2, group_by=["date_day"], as_of=as_of()).count() == 365


def test_moving_deviations(series):
    check = e.expect_column_values_to_be_within_n_moving_stdevs
    found = check(series, "row_value", "date_day", group_by=["group_id"], sigma_threshold=6, as_of=as_of())
    assert {(r.group_id, r.metric_period.day) for r in found.collect()} == {(2, 12)}
    assert check(series, "row_value", "date_day", group_by=["group_id"], sigma_threshold=6, test_periods=2, as_of=as_of()).isEmpty()
    levels = check(series, "row_value", "date_day", take_diffs=False, take_logs=False, sigma_threshold=6, as_of=as_of())
    assert [r.metric_period.day for r in levels.collect()] == [12]
    assert "prior_agg_metric_value" not in levels.columns
    # 0 falls back to the common threshold
    same = check(series, "row_value", "date_day", group_by=["group_id"], sigma_threshold=6, sigma_threshold_upper=0, as_of=as_of())
    assert same.count() == 1


def test_every_period_has_data(series):
    check = e.expect_row_values_to_have_data_for_every_n_datepart
    assert check(series, "date_day").isEmpty()
    gap = series.filter("date_day <> TIMESTAMP_NTZ'2024-02-29 00:00:00'")
    found = check(gap, "date_day").collect()
    assert [(r.date_day, r.is_missing, r.row_cnt) for r in found] == [(dt.datetime(2024, 2, 29), True, 0)]
    assert check(gap, "date_day", exclusion_condition="date_day <> cast('2024-02-29' as timestamp_ntz)").isEmpty()
    assert check(gap, "date_day", interval=7).isEmpty()
    assert check(gap, "date_day", test_start_date="2024-02-28", test_end_date="2024-03-02").count() == 1
    # the end of the range is not tested
    assert check(gap, "date_day", test_start_date="2024-02-20", test_end_date="2024-02-29").isEmpty()
    assert check(series, "date_day", test_start_date="2024-03-10", test_end_date="2024-03-18").count() == 3


# --- suites ------------------------------------------------------------------------------


def test_suite(data):
    checks = [
        Check("t", "expect_column_values_to_be_between", {"column": A, "min_value": 0.2}),
        Check("t", "expect_column_values_to_be_between", {"column": A, "min_value": 0.2}, severity="warn"),
        Check("t", "expect_column_values_to_be_between", {"column": A, "min_value": 0.2}, error_if=">10"),
        Check("t", "expect_column_values_to_be_between", {"column": A, "min_value": 0.2}, error_if=">10", warn_if=">5"),
        Check("t", "not_null", {"column": "col_null", "row_condition": "idx > 2"}),
        Check("t", "unique", {"column": "date_col"}),
        Check("t", "expect_column_max_to_be_between", {"column": A, "max_value": 0.5}),
        Check("t", "expect_table_row_count_to_equal", {"value": 4}),
        Check("t", "expect_table_row_count_to_equal", {"value": 2, "row_condition": "idx > 2"}),
        Check("t", "expect_table_row_count_to_equal", {"value": 1, "group_by": ["date_col"]}),
        Check("t", "expect_compound_columns_to_be_unique", {"column_list": ["date_col", "col_null"]}, fail_calc="cast((count(*)=0) as int)"),
        Check("t", "expect_column_to_exist", {"column": "nothing"}, name="must exist"),
    ]
    got = [(r.failures, r.status) for r in run_suite({"t": data}, checks).orderBy("position").collect()]
    assert got == [
        (1, "fail"), (1, "warn"), (1, "warn"), (1, "pass"), (2, "fail"), (1, "fail"), (1, "fail"), (0, "pass"),
        (0, "pass"), (1, "fail"), (0, "pass"), (1, "fail"),
    ]
    with pytest.raises(ValueError):
        run_suite({"t": data}, [Check("t", "not_null", {"column": "idx"}, error_if="many")])


def test_suite_reads_a_table_once(spark, tmp_path, data):
    path = str(tmp_path / "t")
    data.write.parquet(path)
    checks = [Check("t", "not_null", {"column": c}) for c in ("idx", "date_col", "col_null")]
    checks += [Check("t", "expect_table_row_count_to_equal", {"value": 4})]
    plan = run_suite({"t": spark.read.parquet(path)}, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def test_suites_evaluate_set_checks_in_the_tables_scan(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("b",)], "v string")
    inside, outside = "expect_column_values_to_be_in_set", "expect_column_values_to_not_be_in_set"
    checks = [
        Check("t", inside, {"column": "v", "value_set": ["a", "b"]}),
        Check("t", outside, {"column": "v", "value_set": ["b", "c"]}),
        Check("t", outside, {"column": "v", "value_set": ["b", "b"]}),
        Check("t", inside, {"column": "v", "value_set": ["a"], "row_condition": "v <> 'c'"}),
    ]
    alone = [getattr(e, c.expectation)(df, **c.args).count() for c in checks]
    found = run_suite({"t": df}, checks)
    assert [r.failures for r in found.orderBy("position").collect()] == alone == [2, 3, 4, 2]
    assert run_suite({"t": df}, checks[:2])._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_suites_answer_questions_about_distinct_values_in_the_tables_scan(spark):
    """Against the checks themselves: missing values, -0.0, row conditions, instants a microsecond apart, an empty table."""
    import datetime as dt

    at = dt.datetime(2024, 1, 1)
    rows = [("a", 1, 0.0, at), ("a", 1, -0.0, at), ("b", 2, 1.0, at + dt.timedelta(microseconds=1)), (None, None, None, None), ("c", None, 2.0, None), ("c", 3, float("nan"), at)]
    df = spark.createDataFrame(rows, "value string, _check int, n double, t timestamp_ntz")
    names = ["expect_column_distinct_values_to_be_in_set", "expect_column_distinct_values_to_contain_set", "expect_column_distinct_values_to_equal_set"]
    checks = [Check("t", name, {"column": "value", "value_set": ["a", "z", "b"]}) for name in names]
    checks += [Check("t", name, {"column": "_check", "value_set": [1, 9], "row_condition": "value <> 'b'"}) for name in names]
    for column in ("value", "_check", "n", "t"):
        checks += [
            Check("t", "unique", {"column": column}),
            Check("t", "expect_column_values_to_be_unique", {"column": column, "row_condition": "value = 'a'"}),
            Check("t", "expect_column_distinct_count_to_equal", {"column": column, "value": 3}),
            Check("t", "expect_column_distinct_count_to_be_greater_than", {"column": column, "value": 3}),
            Check("t", "expect_column_unique_value_count_to_be_between", {"column": column, "min_value": 2, "max_value": 3, "strictly": True}),
            Check("t", "expect_column_proportion_of_unique_values_to_be_between", {"column": column, "min_value": 0.7}),
        ]
    checks += [Check("t", "expect_compound_columns_to_be_unique", {"column_list": ["value", "n"], "ignore_row_if_mode": m}) for m in ("all_values_are_missing", "any_value_is_missing")]
    checks += [Check("t", "not_null", {"column": "value"}), Check("t", "expect_table_row_count_to_equal", {"value": 6}), Check("t", "expect_column_sum_to_be_between", {"column": "_check", "max_value": 6})]
    for table in (df, df.limit(0)):
        alone = [getattr(e, c.expectation)(table, **c.args).count() for c in checks]
        found = run_suite({"t": table}, checks)
        assert [r.failures for r in found.orderBy("position").collect()] == alone
    plan = run_suite({"t": df}, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1
