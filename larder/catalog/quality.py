"""Data-quality queries: every expectation over whole tables.

Arguments are chosen so that most checks find failures; a few pass, which is an empty
result on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.entry import Entry
from larder.catalog.sqltext import rnd, with_tables
from larder.catalog.tables import Tables, Warehouse
from larder.functions.numbers import rounded
from larder.operators import expectations as e
from larder.operators.suite import Check, run_suite
from larder.plans import suites

AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


def as_of():
    """The fixed "now" of the checks relative to it."""
    return F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")


def on(table: str, check, *args, **kwargs):
    """A check applied to one raw table."""
    return lambda spark, sf: check(Tables(spark, sf).raw(table), *args, **kwargs)


def true_sql(expr: str, table: str, group_by: tuple = (), where: str = "true") -> str:
    """Failing rows of a predicate, as the checks define them."""
    groups = "".join(f"{g} AS col_{i}, " for i, g in enumerate(group_by, 1))
    tail = f" GROUP BY {', '.join(group_by)}" if group_by else ""
    return (
        f"SELECT * FROM (SELECT {groups}{expr} AS expression FROM {table} WHERE {where}{tail}) "
        "WHERE NOT (expression = true)"
    )


def equal_sql(a: str, b: str, t1: str, t2: str, group_by: tuple = (), w1="true", w2="true", condition="expression_difference > 0") -> str:
    """Two aggregates side by side, kept where they differ."""
    groups = "".join(f"{g} AS col_{i}, " for i, g in enumerate(group_by, 1))
    by = f" GROUP BY {', '.join(group_by)}" if group_by else ""
    names = [f"col_{i}" for i in range(1, len(group_by) + 1)]
    picked = "".join(f"COALESCE(a.{n}, b.{n}) AS {n}, " for n in names)
    join = "a FULL OUTER JOIN b ON " + " AND ".join(f"a.{n} = b.{n}" for n in names) if names else "a CROSS JOIN b"
    return (
        f"WITH a AS (SELECT {groups}{a} AS expression FROM {t1} WHERE {w1}{by}), "
        f"b AS (SELECT {groups}{b} AS expression FROM {t2} WHERE {w2}{by}) "
        f"SELECT * FROM (SELECT {picked}a.expression, b.expression AS compare_expression, "
        "ABS(COALESCE(a.expression, 0) - COALESCE(b.expression, 0)) AS expression_difference, "
        "CAST(ABS(COALESCE(a.expression, 0) - COALESCE(b.expression, 0)) AS DOUBLE) / NULLIF(CAST(a.expression AS DOUBLE), 0) "
        f"AS expression_difference_percent FROM {join}) WHERE {condition}"
    )


def between_sql(expr: str, low, high) -> str:
    parts = ([f"{expr} >= {low}"] if low is not None else []) + ([f"{expr} <= {high}"] if high is not None else [])
    return "(" + " AND ".join(parts) + ")"


def _lag_sql(table: str, value: str, sort: str, op: str, partition: str = "", shown: str = "", step: str = "") -> str:
    over = f"({f'PARTITION BY {partition} ' if partition else ''}ORDER BY {sort}, {value})"
    return (
        f"SELECT {sort} AS sort_column, {shown}{value} AS value_field, value_field_lag FROM "
        f"(SELECT *, LAG({value}) OVER {over} AS value_field_lag FROM {table}) "
        f"WHERE value_field_lag IS NOT NULL AND NOT (({value} {op} value_field_lag){step})"
    )


LINE_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag "
    "l_linestatus l_shipdate"
).split()


def _values_sql(rows: list[tuple], columns: list[str], table: str) -> str:
    """Literal rows, tied to a table that must exist; no rows when ``rows`` is empty."""
    if not rows:
        return f"SELECT {', '.join(f'NULL AS {c}' for c in columns)} FROM {table} WHERE false"
    text = ", ".join("(" + ", ".join("NULL" if v is None else repr(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {text}) v({', '.join(columns)})"


def _with_row_count(check):
    """A metadata result next to the number of rows of the table it describes."""

    def run(spark, sf):
        table = Tables(spark, sf).raw("lineitem")
        rows = table.agg(F.count(F.lit(1)).alias("n")).scalar()
        return check(spark, sf).withColumn("table_rows", rows)

    return run


def meta(name: str, check, rows: list[tuple], columns: list[str], types: dict[str, str] | None = None) -> Entry:
    """A metadata check of the line table; the row count ties the result to the data."""
    shown = ", ".join(f"CAST(v.{c} AS {types[c]}) AS {c}" if c in (types or {}) else f"v.{c}" for c in columns)
    sql = f"SELECT {shown}, (SELECT COUNT(*) FROM lineitem) AS table_rows FROM ({_values_sql(rows, columns, 'lineitem')}) v"
    return Entry(name, _with_row_count(check), sql)


_UPPER = [c.upper() for c in LINE_COLUMNS]
_SHUFFLED = [LINE_COLUMNS[1], LINE_COLUMNS[0], *LINE_COLUMNS[2:]]
_ORDERED_ROWS = [
    (1, "L_ORDERKEY", None, None),
    (2, "L_PARTKEY", None, None),
    (None, None, 1, "L_PARTKEY"),
    (None, None, 2, "L_ORDERKEY"),
]

METADATA = [
    meta(
        "e5_column_to_exist",
        on("lineitem", e.expect_column_to_exist, "l_quantity", column_index=4),
        [("L_QUANTITY", 4, False)],
        ["column_name", "matching_column_index", "column_index_matches"],
    ),
    meta(
        "e9_column_count_between",
        on("lineitem", e.expect_table_column_count_to_be_between, 1, 10),
        [(11, 1, 10)],
        ["number_actual_columns", "min_value", "max_value"],
    ),
    meta(
        "e10_column_count_equal",
        on("lineitem", e.expect_table_column_count_to_equal, 12),
        [(11, 12)],
        ["number_actual_columns", "value"],
    ),
    meta(
        "e11_column_count_equal_other_table",
        lambda s, f: e.expect_table_column_count_to_equal_other_table(
            Tables(s, f).raw("lineitem"), Tables(s, f).raw("orders")
        ),
        [(11, 6)],
        ["number_columns", "compare_number_columns"],
    ),
    meta(
        "e12_columns_contain_set",
        on("lineitem", e.expect_table_columns_to_contain_set, ["l_tax", "l_comment"]),
        [("L_COMMENT", None)],
        ["input_column", "relation_column"],
        {"relation_column": "VARCHAR"},
    ),
    meta(
        "e13_columns_not_contain_set",
        on("lineitem", e.expect_table_columns_to_not_contain_set, ["l_tax", "l_comment"]),
        [("L_TAX", "L_TAX")],
        ["input_column", "relation_column"],
    ),
    meta(
        "e14_columns_match_set",
        on("lineitem", e.expect_table_columns_to_match_set, [*LINE_COLUMNS[1:], "l_comment"]),
        [("L_ORDERKEY", None), (None, "L_COMMENT")],
        ["relation_column", "input_column"],
    ),
    meta(
        "e15_columns_match_ordered_list",
        on("lineitem", e.expect_table_columns_to_match_ordered_list, _SHUFFLED),
        _ORDERED_ROWS,
        ["relation_column_idx", "relation_column", "input_column_idx", "input_column"],
    ),
    meta(
        "e28_values_of_type",
        on("lineitem", e.expect_column_values_to_be_of_type, "l_orderkey", "VARCHAR"),
        [("L_ORDERKEY", "BIGINT")],
        ["relation_column", "relation_column_type"],
    ),
    meta(
        "e29_values_in_type_list",
        on("lineitem", e.expect_column_values_to_be_in_type_list, "l_quantity", ["INTEGER", "BIGINT"]),
        [("L_QUANTITY", "DOUBLE")],
        ["relation_column", "relation_column_type"],
    ),
]


def _two(check, first: str, second: str, *args, **kwargs):
    return lambda spark, sf: check(Tables(spark, sf).raw(first), *args, Tables(spark, sf).raw(second), **kwargs)


def _ignored(mode: str):
    def run(spark, sf):
        retail = Tables(spark, sf).retail
        keep = e.ignore_row_if(mode, ["category_name", "store_city"])
        return retail.filter(keep).groupBy("store_id").agg(F.count(F.lit(1)).alias("kept"))

    return run


def _moving(spark, sf):
    found = e.expect_column_values_to_be_within_n_moving_stdevs(
        Tables(spark, sf).raw("events"), "value", "ts", group_by=["event_type"], sigma_threshold=1, as_of=as_of()
    )
    places = [
        "agg_metric_value", "prior_agg_metric_value", "metric_test_value", "metric_test_rolling_average",
        "metric_test_rolling_stddev", "metric_test_delta", "metric_test_sigma",
    ]
    return found.select("metric_period", "event_type", *(rounded(F.col(p), 4).alias(p) for p in places))


_LOG = "COALESCE(LN(NULLIF({}, 0)), 0)"
_MOVING_SQL = f"""
SELECT CAST(day AS TIMESTAMP) AS metric_period, event_type, {rnd('total', 4)} AS agg_metric_value, {rnd('before', 4)} AS prior_agg_metric_value,
  {rnd('change', 4)} AS metric_test_value, {rnd('usual', 4)} AS metric_test_rolling_average, {rnd('spread', 4)} AS metric_test_rolling_stddev,
  {rnd('change - usual', 4)} AS metric_test_delta, {rnd('(change - usual) / NULLIF(spread, 0)', 4)} AS metric_test_sigma
FROM (SELECT *, AVG(change) OVER week AS usual, STDDEV(change) OVER week AS spread
  FROM (SELECT DATE_TRUNC('day', ts) AS day, event_type, SUM(value) AS total,
      LAG(SUM(value)) OVER (PARTITION BY event_type ORDER BY DATE_TRUNC('day', ts)) AS before,
      {_LOG.format('SUM(value)')} - {_LOG.format("LAG(SUM(value)) OVER (PARTITION BY event_type ORDER BY DATE_TRUNC('day', ts))")} AS change
    FROM events GROUP BY 1, 2)
  WINDOW week AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
WHERE day BETWEEN DATE_TRUNC('day', {AS_OF_SQL}) - INTERVAL 14 DAY AND DATE_TRUNC('day', {AS_OF_SQL}) - INTERVAL 1 DAY
  AND NOT ABS((change - usual) / NULLIF(spread, 0)) <= 1"""


def _stdevs(spark, sf):
    found = e.expect_column_values_to_be_within_n_stdevs(
        Tables(spark, sf).raw("lineitem"), "l_quantity", group_by=["l_suppkey"], sigma_threshold=1.5
    )
    names = ["l_quantity", "l_quantity_average", "l_quantity_stddev", "l_quantity_sigma"]
    return found.select("l_suppkey", *(rounded(F.col(n), 3).alias(n) for n in names))


_STDEVS_SQL = f"""
SELECT l_suppkey, {rnd('q', 3)} AS l_quantity, {rnd('m', 3)} AS l_quantity_average, {rnd('s', 3)} AS l_quantity_stddev,
  {rnd('(q - m) / NULLIF(s, 0)', 3)} AS l_quantity_sigma
FROM (SELECT *, AVG(q) OVER () AS m, STDDEV(q) OVER () AS s
      FROM (SELECT l_suppkey, SUM(l_quantity) AS q FROM lineitem GROUP BY 1)) WHERE ABS((q - m) / NULLIF(s, 0)) > 1.5"""


def _every(**options):
    def run(spark, sf):
        return e.expect_row_values_to_have_data_for_every_n_datepart(
            Tables(spark, sf).raw("events"), "ts", **options
        )

    return run


_RARE = "event_type = 'error' AND value > 20"
_RARER = "event_type = 'error' AND value > 60"


def _every_sql(part: str, interval: int | None = None, where: str = "true") -> str:
    rows = f"events WHERE {where}"
    bucket = f"DATE_TRUNC('{part}', ts)"
    if interval:
        bucket += f" - CAST(date_diff('{part}', s, ts) % {interval} AS INT) * INTERVAL 1 {part}"
    keep = f" WHERE i % {interval} = 0" if interval else ""
    return f"""WITH b AS (SELECT MIN(CAST(ts AS DATE))::TIMESTAMP AS s, MAX(CAST(ts AS DATE))::TIMESTAMP AS e FROM {rows}),
      spine AS (SELECT s + CAST(i AS INT) * INTERVAL 1 {part} AS p FROM
        (SELECT s, UNNEST(range(date_diff('{part}', s, e))) AS i FROM b){keep}),
      data AS (SELECT CAST({bucket} AS TIMESTAMP) AS p, COUNT(*) AS n FROM (SELECT ts FROM {rows}), b GROUP BY 1)
    SELECT spine.p AS date_{part}, data.p IS NULL AS is_missing, COALESCE(n, 0) AS row_cnt
    FROM spine LEFT JOIN data ON spine.p = data.p WHERE COALESCE(n, 0) = 0"""


def _grouped_recent(spark, sf):
    return e.expect_grouped_row_values_to_have_recent_data(
        Tables(spark, sf).raw("events"), "ts", "hour", 12, group_by=["user_id"], as_of=as_of()
    )


def _within_record(**options):
    columns = ["l_linenumber", "l_suppkey", "l_partkey"]
    return lambda s, f: e.expect_select_column_values_to_be_unique_within_record(Tables(s, f).raw("lineitem"), columns, **options)


def _within_sql(rows: str) -> str:
    distinct = "len(list_distinct([l_linenumber::BIGINT, l_suppkey::BIGINT, l_partkey::BIGINT]))"
    return (
        f"SELECT * FROM (SELECT ROW_NUMBER() OVER (ORDER BY l_linenumber, l_suppkey, l_partkey) AS row_index, {distinct} AS column_values "
        f"FROM {rows}) WHERE column_values < 3"
    )


def _casing(display: bool):
    def run(spark, sf):
        lines = Tables(spark, sf).raw("lineitem")
        mixed = lines.withColumn("flag", F.when(F.col("l_linestatus") == "O", F.lower("l_returnflag")).otherwise(F.col("l_returnflag")))
        return e.expect_column_values_to_have_consistent_casing(mixed, "flag", display)

    return run


_CASING_FROM = (
    "(SELECT DISTINCT CASE WHEN l_linestatus = 'O' THEN lower(l_returnflag) ELSE l_returnflag END AS d FROM lineitem)"
)


def _suite_tables(spark, sf):
    t = Warehouse(spark, sf)
    grocery = t.bronze("instacart_grocery")
    from larder.operators.silver import stg_instacart_grocery

    return {
        "retail_data": t.retail_lines_only,
        **{name: t.bronze(name) for name in ("m5_forcasting", "iot_telemetry", "SupplyChain")},
        "instacart_grocery": grocery,
        "stg_instacart_grocery": stg_instacart_grocery(grocery),
        "silver_fact_cold_chain": t.readings,
        "gold_mart_food_waste_summary": t.waste,
    }


def _suite(spark, sf):
    return run_suite(_suite_tables(spark, sf), suites.PROJECT).select("position", "table_name", "failures", "status")


def _suite_sql() -> str:
    source = {
        "retail_data": "retail", "m5_forcasting": "m5", "iot_telemetry": "iot", "SupplyChain": "supply",
        "instacart_grocery": "grocery", "stg_instacart_grocery": "grocery",
        "silver_fact_cold_chain": "fact_cold_chain", "gold_mart_food_waste_summary": "food_waste",
    }
    parts = []
    for i, check in enumerate(suites.PROJECT):
        table, a = source[check.table], check.args
        column = a.get("column", "").replace("`", '"')
        if check.expectation == "not_null":
            count = f"SELECT COUNT(*) AS n FROM {table} WHERE {column} IS NULL"
        elif check.expectation == "unique":
            count = (
                f"SELECT COUNT(*) AS n FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
                f"GROUP BY {column} HAVING COUNT(*) > 1)"
            )
        elif check.expectation == "expect_column_values_to_be_in_set":
            listed = ", ".join(f"'{v}'" for v in a["value_set"])
            count = f"SELECT COUNT(*) AS n FROM {table} WHERE {column} IS NULL OR {column} NOT IN ({listed})"
        elif column:
            count = f"SELECT COUNT(*) AS n FROM {table} WHERE NOT ({column} BETWEEN {a['min_value']} AND {a['max_value']})"
        else:
            count = (
                f"SELECT CASE WHEN COUNT(*) BETWEEN {a['min_value']} AND {a['max_value']} THEN 0 ELSE 1 END AS n FROM {table}"
            )
        parts.append(
            f"SELECT {i} AS position, '{check.table}' AS table_name, n AS failures, "
            f"CASE WHEN n <> 0 THEN 'fail' ELSE 'pass' END AS status FROM ({count})"
        )
    return with_tables(" UNION ALL ".join(parts), *dict.fromkeys(source.values()))


THRESHOLDS = [
    Check("events", "expect_column_values_to_match_regex", {"column": "props", "regex": "k.: 1"}, error_if="=0", warn_if="<4"),
    Check("events", "expect_column_values_to_be_between", {"column": "value", "max_value": 100}, severity="warn"),
    Check("events", "expect_column_distinct_count_to_equal", {"column": "event_type", "value": 5}, warn_if="!=0"),
    Check(
        "events",
        "expect_compound_columns_to_be_unique",
        {"column_list": ["user_id", "event_type"]},
        fail_calc="cast((count(*)=0) as int)",
    ),
]


def _thresholds(spark, sf):
    return run_suite({"events": Tables(spark, sf).raw("events")}, THRESHOLDS).select("position", "failures", "status")


_THRESHOLDS_SQL = """
WITH f AS (
  SELECT 0 AS position, COUNT(*) AS n FROM events WHERE NOT regexp_matches(props, 'k.: 1')
  UNION ALL SELECT 1, COUNT(*) FROM events WHERE NOT (value <= 100)
  UNION ALL SELECT 2, CASE WHEN COUNT(DISTINCT event_type) = 5 THEN 0 ELSE 1 END FROM events
  UNION ALL SELECT 3, CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END
    FROM (SELECT user_id, event_type FROM events GROUP BY 1, 2 HAVING COUNT(*) > 1))
SELECT position, n AS failures, CASE position
  WHEN 0 THEN CASE WHEN n = 0 THEN 'fail' WHEN n < 4 THEN 'warn' ELSE 'pass' END
  WHEN 1 THEN CASE WHEN n <> 0 THEN 'warn' ELSE 'pass' END
  ELSE CASE WHEN n <> 0 THEN 'fail' ELSE 'pass' END END AS status FROM f"""

#: What a table of lines must look like, and what must hold of its rows: one scan answers the second kind.
LINES = [
    Check("lines", "expect_column_to_exist", {"column": "l_quantity", "column_index": 4}),
    Check("lines", "expect_table_column_count_to_be_between", {"min_value": 1, "max_value": 10}),
    Check("lines", "expect_table_column_count_to_equal", {"value": 11}),
    Check("lines", "expect_table_columns_to_contain_set", {"column_list": ["l_tax", "l_comment"]}),
    Check("lines", "expect_table_columns_to_not_contain_set", {"column_list": ["l_tax", "l_comment"]}),
    Check("lines", "expect_table_columns_to_match_set", {"column_list": [*LINE_COLUMNS[1:], "l_comment"]}),
    Check("lines", "expect_table_columns_to_match_ordered_list", {"column_list": _SHUFFLED}),
    Check("lines", "expect_column_values_to_be_of_type", {"column": "l_orderkey", "column_type": "VARCHAR"}),
    Check("lines", "expect_column_values_to_be_in_type_list", {"column": "l_quantity", "column_type_list": ["INTEGER", "DOUBLE"]}),
    Check("lines", "expect_compound_columns_to_be_unique", {"column_list": ["l_orderkey", "l_partkey"]}),
    Check("lines", "expect_column_values_to_be_unique", {"column": "l_orderkey"}),
    Check("lines", "expect_column_distinct_count_to_equal", {"column": "l_linestatus", "value": 2}),
    Check("lines", "expect_column_distinct_values_to_equal_set", {"column": "l_returnflag", "value_set": ["A", "B"]}),
    Check("lines", "expect_column_distinct_values_to_contain_set", {"column": "l_returnflag", "value_set": ["A", "Z"], "row_condition": "l_tax > 0.02"}),
    Check("lines", "expect_column_proportion_of_unique_values_to_be_between", {"column": "l_orderkey", "min_value": 0.9}),
    Check("lines", "expect_column_values_to_be_between", {"column": "l_quantity", "min_value": 2, "max_value": 49}),
]


def _line_suite(spark, sf):
    return run_suite({"lines": Tables(spark, sf).raw("lineitem")}, LINES).select("position", "failures", "status")


def _line_sql() -> str:
    """The failures of every check in its own words; the columns come from the table's description."""
    quoted = lambda names: ", ".join(f"'{n.upper()}'" for n in names)
    listed = lambda names: f"(SELECT UNNEST([{quoted(names)}]) AS name)"
    places = ", ".join(f"({k}, '{n.upper()}')" for k, n in enumerate(_SHUFFLED, 1))
    set_of = [*LINE_COLUMNS[1:], "l_comment"]
    counts = [
        "SELECT IF((SELECT place FROM cols WHERE name = 'L_QUANTITY') = 4, 0, 1)",
        "SELECT IF(COUNT(*) BETWEEN 1 AND 10, 0, 1) FROM cols",
        "SELECT IF(COUNT(*) = 11, 0, 1) FROM cols",
        f"SELECT COUNT(*) FROM {listed(['l_tax', 'l_comment'])} WHERE name NOT IN (SELECT name FROM cols)",
        f"SELECT COUNT(*) FROM cols WHERE name IN ({quoted(['l_tax', 'l_comment'])})",
        f"SELECT COUNT(*) FROM (SELECT name FROM cols) a FULL JOIN {listed(set_of)} b USING (name) WHERE a.name IS NULL OR b.name IS NULL",
        f"SELECT COUNT(*) FROM cols a FULL JOIN (VALUES {places}) b(place, name) ON a.place = b.place AND a.name = b.name WHERE a.name IS NULL OR b.name IS NULL",
        "SELECT COUNT(*) FROM cols WHERE name = 'L_ORDERKEY' AND kind <> 'VARCHAR'",
        "SELECT COUNT(*) FROM cols WHERE name = 'L_QUANTITY' AND kind NOT IN ('INTEGER', 'DOUBLE')",
        "SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey HAVING COUNT(*) > 1)",
        "SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING COUNT(*) > 1)",
        "SELECT IF(COUNT(DISTINCT l_linestatus) = 2, 0, 1) FROM lineitem",
        "SELECT COUNT(*) FROM (SELECT DISTINCT l_returnflag AS f FROM lineitem) a FULL JOIN (SELECT UNNEST(['A', 'B']) AS f) b USING (f) WHERE a.f IS NULL OR b.f IS NULL",
        "SELECT COUNT(*) FROM (SELECT UNNEST(['A', 'Z']) AS f) WHERE f NOT IN (SELECT l_returnflag FROM lineitem WHERE l_tax > 0.02)",
        "SELECT IF(COUNT(DISTINCT l_orderkey)::DOUBLE / COUNT(l_orderkey) >= 0.9, 0, 1) FROM lineitem",
        "SELECT COUNT(*) FROM lineitem WHERE NOT (l_quantity BETWEEN 2 AND 49)",
    ]
    rows = " UNION ALL ".join(f"SELECT {k} AS position, ({count}) AS failures" for k, count in enumerate(counts))
    return (
        "WITH cols AS (SELECT upper(column_name) AS name, column_type AS kind, row_number() OVER () AS place FROM (DESCRIBE lineitem)) "
        f"SELECT position, failures, IF(failures = 0, 'pass', 'fail') AS status FROM ({rows})"
    )


_EN = "lang = 'en'"

ENTRIES = [
    Entry(
        "e1_expression_is_true",
        on("lineitem", e.expression_is_true, "l_quantity * 1000 < l_extendedprice", row_condition="l_discount > 0.05"),
        true_sql("l_quantity * 1000 < l_extendedprice", "lineitem", where="l_discount > 0.05"),
    ),
    Entry(
        "e1_expression_is_true_grouped",
        on("lineitem", e.expression_is_true, "sum(l_quantity) > 800", group_by=["l_suppkey", "l_returnflag"]),
        true_sql("SUM(l_quantity) > 800", "lineitem", ("l_suppkey", "l_returnflag")),
    ),
    Entry(
        "e1_expression_is_true_grouped_mean",
        on("lineitem", e.expression_is_true, "avg(l_quantity) > 25", group_by=["l_suppkey", "l_returnflag"]),
        true_sql("AVG(l_quantity) > 25", "lineitem", ("l_suppkey", "l_returnflag")),
    ),
    Entry(
        "e1_expression_is_false",
        on("lineitem", e.expression_is_true, "l_tax > 0.04", test_condition="= false"),
        "SELECT * FROM (SELECT l_tax > 0.04 AS expression FROM lineitem) WHERE NOT (expression = false)",
    ),
    Entry(
        "e2_expression_between",
        on("lineitem", e.expression_between, "avg(l_quantity)", 24, 26, group_by=["l_suppkey"], strictly=True),
        true_sql("(AVG(l_quantity) > 24 AND AVG(l_quantity) < 26)", "lineitem", ("l_suppkey",)),
    ),
    Entry(
        "e3_equal_expression_grouped",
        _two(e.equal_expression, "lineitem", "lineitem", "count(*)", compare_expression="count(distinct l_orderkey)", group_by=["l_suppkey"]),
        equal_sql("COUNT(*)", "COUNT(DISTINCT l_orderkey)", "lineitem", "lineitem", ("l_suppkey",)),
    ),
    Entry(
        "e3_equal_expression_total",
        _two(e.equal_expression, "lineitem", "orders", "count(*)", compare_expression="sum(o_custkey)", tolerance_percent=0.01),
        equal_sql("COUNT(*)", "CAST(SUM(o_custkey) AS BIGINT)", "lineitem", "orders", condition="expression_difference_percent > 0.01"),
    ),
    *(
        Entry(
            f"e4_ignore_row_if_{mode.split('_')[0]}",
            _ignored(mode),
            with_tables(
                f"SELECT store_id, COUNT(*) AS kept FROM retail WHERE NOT (category_name IS NULL {op} store_city IS NULL) GROUP BY 1",
                "retail",
            ),
        )
        for mode, op in (("all_values_are_missing", "AND"), ("any_value_is_missing", "OR"))
    ),
    *METADATA,
    Entry(
        "e6_recent_data",
        lambda s, f: e.expect_row_values_to_have_recent_data(
            Tables(s, f).raw("events"), "ts", "minute", 1, as_of=as_of()
        ),
        f"SELECT * FROM (SELECT MAX(ts) AS max_timestamp FROM events WHERE ts <= {AS_OF_SQL}) WHERE "
        f"COALESCE(max_timestamp, TIMESTAMP '1970-01-01') < {AS_OF_SQL} - INTERVAL 1 MINUTE",
    ),
    Entry(
        "e7_grouped_recent_data",
        _grouped_recent,
        "SELECT CAST(1 AS BIGINT) AS row_count, user_id, 1 AS join_key, latest_timestamp_column FROM (SELECT user_id, MAX(ts) AS "
        f"latest_timestamp_column FROM events WHERE ts <= {AS_OF_SQL} GROUP BY 1) WHERE latest_timestamp_column < {AS_OF_SQL} - INTERVAL 12 HOUR",
    ),
    Entry(
        "e8_aggregation_equal_other_table",
        lambda s, f: e.expect_table_aggregation_to_equal_other_table(
            Tables(s, f).raw("lineitem"), "count(distinct l_orderkey)", Tables(s, f).raw("orders"), compare_expression="count(*)"
        ),
        equal_sql("COUNT(DISTINCT l_orderkey)", "COUNT(*)", "lineitem", "orders"),
    ),
    Entry(
        "e16_row_count_between",
        on("lineitem", e.expect_table_row_count_to_be_between, 550, 650, group_by=["l_suppkey"]),
        true_sql("(COUNT(*) >= 550 AND COUNT(*) <= 650)", "lineitem", ("l_suppkey",)),
    ),
    Entry(
        "e17_row_count_equal",
        on("lineitem", e.expect_table_row_count_to_equal, 4, group_by=["l_orderkey"]),
        true_sql("COUNT(*) = 4", "lineitem", ("l_orderkey",)),
    ),
    Entry(
        "e18_row_count_equal_other_table",
        _two(e.expect_table_row_count_to_equal_other_table, "lineitem", "orders"),
        equal_sql("COUNT(*)", "COUNT(*)", "lineitem", "orders"),
    ),
    Entry(
        "e19_row_count_times_factor",
        lambda s, f: e.expect_table_row_count_to_equal_other_table_times_factor(
            Tables(s, f).raw("lineitem"), Tables(s, f).raw("orders"), 3,
            group_by=["l_orderkey"], compare_group_by=["o_orderkey"],
        ),
        "WITH a AS (SELECT l_orderkey AS col_1, COUNT(*) AS expression FROM lineitem GROUP BY 1), "
        "b AS (SELECT o_orderkey AS col_1, COUNT(*) * 3 AS expression FROM orders GROUP BY 1) "
        "SELECT * FROM (SELECT COALESCE(a.col_1, b.col_1) AS col_1, a.expression, b.expression AS compare_expression, "
        "ABS(COALESCE(a.expression, 0) - COALESCE(b.expression, 0)) AS expression_difference, "
        "CAST(ABS(COALESCE(a.expression, 0) - COALESCE(b.expression, 0)) AS DOUBLE) / NULLIF(CAST(a.expression AS DOUBLE), 0) "
        "AS expression_difference_percent FROM a FULL OUTER JOIN b ON a.col_1 = b.col_1) WHERE expression_difference > 0",
    ),
    Entry(
        "e20_values_between",
        on("lineitem", e.expect_column_values_to_be_between, "l_quantity", 5, 45, row_condition="l_tax > 0"),
        true_sql("(l_quantity >= 5 AND l_quantity <= 45)", "lineitem", where="l_tax > 0"),
    ),
    Entry(
        "e20_values_between_all",
        on("lineitem", e.expect_column_values_to_be_between, "l_quantity", 5, 45),
        true_sql("(l_quantity >= 5 AND l_quantity <= 45)", "lineitem"),
    ),
    Entry(
        "e21_values_increasing",
        on("events", e.expect_column_values_to_be_increasing, "value", sort_column="ts"),
        _lag_sql("events", "value", "ts", ">"),
    ),
    Entry(
        "e21_values_increasing_grouped",
        on("lineitem", e.expect_column_values_to_be_increasing, "l_linenumber", sort_column="l_quantity",
           group_by=["l_suppkey"], strictly=True, step=1),
        _lag_sql("lineitem", "l_linenumber", "l_quantity", ">", "l_suppkey", "l_suppkey, ", " AND ((l_linenumber - value_field_lag) = 1)"),
    ),
    Entry(
        "e22_values_decreasing",
        on("events", e.expect_column_values_to_be_decreasing, "value", sort_column="ts", group_by=["user_id"], strictly=False),
        _lag_sql("events", "value", "ts", "<=", "user_id"),
    ),
    Entry(
        "e23_values_in_set",
        on("lineitem", e.expect_column_values_to_be_in_set, "l_returnflag", ["A", "N"]),
        "SELECT l_returnflag AS value_field FROM lineitem WHERE l_returnflag IS NULL OR l_returnflag NOT IN ('A', 'N')",
    ),
    Entry(
        "e24_values_not_in_set",
        on("lineitem", e.expect_column_values_to_not_be_in_set, "l_linenumber", [2, 3, 3], quote_values=False),
        "SELECT l_linenumber AS value_field FROM lineitem JOIN (VALUES (2), (3), (3)) s(x) ON l_linenumber = x",
    ),
    Entry(
        "e25_values_null",
        lambda s, f: e.expect_column_values_to_be_null(Tables(s, f).retail, "category_name", row_condition="qty > 40"),
        with_tables(true_sql("category_name IS NULL", "retail", where="qty > 40"), "retail"),
    ),
    Entry(
        "e25_values_null_all",
        lambda s, f: e.expect_column_values_to_be_null(Tables(s, f).retail, "category_name"),
        with_tables(true_sql("category_name IS NULL", "retail"), "retail"),
    ),
    Entry(
        "e26_values_not_null",
        lambda s, f: e.expect_column_values_to_not_be_null(Tables(s, f).retail, "category_name"),
        with_tables(true_sql("category_name IS NOT NULL", "retail"), "retail"),
    ),
    Entry(
        "e27_values_unique",
        on("lineitem", e.expect_column_values_to_be_unique, "l_extendedprice"),
        "SELECT l_extendedprice, COUNT(*) AS n_records FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1",
    ),
    Entry(
        "e30_consistent_casing",
        _casing(False),
        f"SELECT * FROM (SELECT COUNT(1) AS set_count, COUNT(DISTINCT lower(d)) AS set_count_case_insensitive FROM {_CASING_FROM}) "
        "WHERE set_count != set_count_case_insensitive",
    ),
    Entry(
        "e30_consistent_casing_listed",
        _casing(True),
        f"SELECT lower(d) AS inconsistent_columns, COUNT(d) AS set_count_case_insensitive FROM {_CASING_FROM} GROUP BY 1 HAVING COUNT(d) > 1",
    ),
    Entry(
        "e31_lengths_between",
        on("documents", e.expect_column_value_lengths_to_be_between, "text", 100, 2000),
        true_sql("(length(text) >= 100 AND length(text) <= 2000)", "documents"),
    ),
    Entry(
        "e32_lengths_equal",
        on("documents", e.expect_column_value_lengths_to_equal, "source", 4),
        true_sql("length(source) = 4", "documents"),
    ),
    Entry(
        "e33_match_like",
        on("documents", e.expect_column_values_to_match_like_pattern, "text", "%the%"),
        true_sql("text LIKE '%the%'", "documents"),
    ),
    Entry(
        "e34_not_match_like",
        on("documents", e.expect_column_values_to_not_match_like_pattern, "text", "%@%"),
        true_sql("NOT (text LIKE '%@%')", "documents"),
    ),
    Entry(
        "e35_match_like_list",
        on("documents", e.expect_column_values_to_match_like_pattern_list, "text", ["%the%", "%le %"], match_on="all"),
        true_sql("(text LIKE '%the%' AND text LIKE '%le %')", "documents"),
    ),
    Entry(
        "e36_not_match_like_list",
        on("documents", e.expect_column_values_to_not_match_like_pattern_list, "text", ["%the%", "%an%"]),
        true_sql("(NOT text LIKE '%the%' OR NOT text LIKE '%an%')", "documents"),
    ),
    Entry(
        "e37_match_regex",
        on("documents", e.expect_column_values_to_match_regex, "text", "[A-Z][a-z]+ THE ", flags="i"),
        true_sql("regexp_matches(text, '[A-Z][a-z]+ THE ', 'i')", "documents"),
    ),
    Entry(
        "e38_not_match_regex",
        on("documents", e.expect_column_values_to_not_match_regex, "text", "@[^.]*", row_condition=_EN),
        true_sql("NOT regexp_matches(text, '@[^.]*')", "documents", where=_EN),
    ),
    Entry(
        "e38_not_match_regex_all",
        on("documents", e.expect_column_values_to_not_match_regex, "text", "@[^.]*"),
        true_sql("NOT regexp_matches(text, '@[^.]*')", "documents"),
    ),
    Entry(
        "e39_match_regex_list",
        on("documents", e.expect_column_values_to_match_regex_list, "text", ["[0-9]{3}", "@[a-z]"], match_on="all"),
        true_sql("(regexp_matches(text, '[0-9]{3}') AND regexp_matches(text, '@[a-z]'))", "documents"),
    ),
    Entry(
        "e40_not_match_regex_list",
        on("documents", e.expect_column_values_to_not_match_regex_list, "text", ["[0-9]{3}", "the"]),
        true_sql("(NOT regexp_matches(text, '[0-9]{3}') OR NOT regexp_matches(text, 'the'))", "documents"),
    ),
    Entry(
        "e41_distinct_count_equal",
        on("lineitem", e.expect_column_distinct_count_to_equal, "l_linenumber", 4, group_by=["l_orderkey"]),
        true_sql("COUNT(DISTINCT l_linenumber) = 4", "lineitem", ("l_orderkey",)),
    ),
    Entry(
        "e42_distinct_count_greater",
        on("lineitem", e.expect_column_distinct_count_to_be_greater_than, "l_linenumber", 2, group_by=["l_orderkey"]),
        true_sql("COUNT(DISTINCT l_linenumber) > 2", "lineitem", ("l_orderkey",)),
    ),
    Entry(
        "e43_distinct_count_less",
        on("lineitem", e.expect_column_distinct_count_to_be_less_than, "l_linenumber", 5, group_by=["l_orderkey"]),
        true_sql("COUNT(DISTINCT l_linenumber) < 5", "lineitem", ("l_orderkey",)),
    ),
    Entry(
        "e44_distinct_count_equal_other_table",
        lambda s, f: e.expect_column_distinct_count_to_equal_other_table(
            Tables(s, f).raw("lineitem"), "l_orderkey", Tables(s, f).raw("orders"), "o_orderkey"
        ),
        equal_sql("COUNT(DISTINCT l_orderkey)", "COUNT(DISTINCT o_orderkey)", "lineitem", "orders"),
    ),
    Entry(
        "e45_distinct_values_in_set",
        on("part", e.expect_column_distinct_values_to_be_in_set, "p_brand", ["Brand#1", "Brand#2", "Brand#2"]),
        "SELECT DISTINCT p_brand AS value_field FROM part WHERE p_brand IS NULL OR p_brand NOT IN ('Brand#1', 'Brand#2')",
    ),
    Entry(
        "e46_distinct_values_contain_set",
        on("part", e.expect_column_distinct_values_to_contain_set, "p_brand", ["Brand#1", "Brand#77", "Brand#78", "Brand#78"]),
        "SELECT DISTINCT x AS value_field FROM (VALUES ('Brand#1'), ('Brand#77'), ('Brand#78')) s(x) "
        "WHERE x NOT IN (SELECT p_brand FROM part WHERE p_brand IS NOT NULL)",
    ),
    Entry(
        "e47_distinct_values_equal_set",
        on("lineitem", e.expect_column_distinct_values_to_equal_set, "l_linenumber", [1, 2, 9, 9], quote_values=False),
        "SELECT v.column_value, s.value_field FROM (SELECT DISTINCT l_linenumber AS column_value FROM lineitem) v FULL OUTER JOIN "
        "(SELECT DISTINCT x AS value_field FROM (VALUES (1), (2), (9), (9)) t(x)) s ON v.column_value = s.value_field "
        "WHERE v.column_value IS NULL OR s.value_field IS NULL",
    ),
    *(
        Entry(
            f"{key}_{short}_between",
            on("lineitem", check, "l_quantity", low, high, group_by=["l_suppkey"]),
            true_sql(between_sql(expr, low, high), "lineitem", ("l_suppkey",)),
        )
        for key, short, check, expr, low, high in (
            ("e48", "max", e.expect_column_max_to_be_between, "MAX(l_quantity)", 1, 49),
            ("e49", "mean", e.expect_column_mean_to_be_between, "AVG(l_quantity)", 25, None),
            ("e50", "median", e.expect_column_median_to_be_between, "MEDIAN(l_quantity)", 25.5, 60),
            ("e51", "min", e.expect_column_min_to_be_between, "MIN(l_quantity)", 2, 50),
            ("e53", "stdev", e.expect_column_stdev_to_be_between, "STDDEV(l_quantity)", 14, 14.5),
            ("e54", "sum", e.expect_column_sum_to_be_between, "SUM(l_quantity)", None, 15300),
            ("e55", "unique_value_count", e.expect_column_unique_value_count_to_be_between, "COUNT(DISTINCT l_quantity)", 51, None),
            ("e56", "proportion_of_unique_values", e.expect_column_proportion_of_unique_values_to_be_between,
             "CAST(COUNT(DISTINCT l_quantity) AS DOUBLE) / COUNT(l_quantity)", 0.08, 0.082),
        )
    ),
    Entry(
        "e52_quantile_between",
        on("lineitem", e.expect_column_quantile_values_to_be_between, "l_extendedprice", 0.95, None, 99000, group_by=["l_suppkey"]),
        true_sql("(quantile_cont(l_extendedprice, 0.95) <= 99000)", "lineitem", ("l_suppkey",)),
    ),
    Entry(
        "e57_most_common_value_in_set",
        on("part", e.expect_column_most_common_value_to_be_in_set, "p_brand", ["Brand#1"], 2),
        "SELECT p_brand AS value_field FROM (SELECT p_brand, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, p_brand) AS rn "
        "FROM part GROUP BY 1) WHERE rn = 2 AND p_brand NOT IN ('Brand#1')",
    ),
    Entry(
        "e58_pair_greater",
        on("lineitem", e.expect_column_pair_values_A_to_be_greater_than_B, "l_extendedprice / 1000", "l_quantity", or_equal=True),
        true_sql("l_extendedprice / 1000 >= l_quantity", "lineitem"),
    ),
    Entry(
        "e59_pair_equal",
        on("lineitem", e.expect_column_pair_values_to_be_equal, "l_linenumber", "l_suppkey", row_condition="l_suppkey < 8"),
        true_sql("l_linenumber = l_suppkey", "lineitem", where="l_suppkey < 8"),
    ),
    Entry(
        "e59_pair_equal_all",
        on("lineitem", e.expect_column_pair_values_to_be_equal, "l_linenumber", "l_suppkey"),
        true_sql("l_linenumber = l_suppkey", "lineitem"),
    ),
    Entry(
        "e60_pair_in_set",
        on("lineitem", e.expect_column_pair_values_to_be_in_set, "l_returnflag", "l_linestatus", [["A", "F"], ["R", "F"], ["N", "O"]]),
        true_sql(
            "((l_returnflag = 'A' AND l_linestatus = 'F') OR (l_returnflag = 'R' AND l_linestatus = 'F') OR "
            "(l_returnflag = 'N' AND l_linestatus = 'O'))",
            "lineitem",
        ),
    ),
    Entry(
        "e61_compound_unique",
        on("lineitem", e.expect_compound_columns_to_be_unique, ["l_orderkey", "l_linenumber"]),
        "SELECT l_orderkey, l_linenumber, COUNT(*) AS n_records FROM lineitem WHERE NOT (l_orderkey IS NULL AND l_linenumber IS NULL) "
        "GROUP BY 1, 2 HAVING COUNT(*) > 1",
    ),
    Entry("e62_unique_within_record", _within_record(row_condition="l_quantity > 10"), _within_sql("lineitem WHERE l_quantity > 10")),
    Entry("e62_unique_within_record_all", _within_record(), _within_sql("lineitem")),
    Entry(
        "e63_multicolumn_sum",
        on("lineitem", e.expect_multicolumn_sum_to_equal, ["l_linenumber", "l_suppkey"], "l_partkey", group_by=["l_orderkey"]),
        true_sql("SUM(l_linenumber) + SUM(l_suppkey) = SUM(l_partkey)", "lineitem", ("l_orderkey",)),
    ),
    Entry("e64_within_n_moving_stdevs", _moving, _MOVING_SQL),
    Entry("e65_within_n_stdevs", _stdevs, _STDEVS_SQL),
    Entry("e66_data_for_every_hour", _every(date_part="hour", row_condition=_RARE), _every_sql("hour", where=_RARE)),
    Entry("e66_data_for_every_minute_all", _every(date_part="minute"), _every_sql("minute")),
    Entry("e66_data_for_every_8_hours", _every(date_part="hour", interval=8, row_condition=_RARE), _every_sql("hour", 8, _RARE)),
    Entry("e66_data_for_every_8_hours_rare", _every(date_part="hour", interval=8, row_condition=_RARER), _every_sql("hour", 8, _RARER)),
    Entry("e66_data_for_every_5_minutes_all", _every(date_part="minute", interval=5), _every_sql("minute", 5)),
    Entry(
        "e67_not_null",
        lambda s, f: e.not_null(Tables(s, f).retail, "store_city").select("order_item_id", "store_id"),
        with_tables("SELECT order_item_id, store_id FROM retail WHERE store_city IS NULL", "retail"),
    ),
    Entry(
        "e67_unique",
        lambda s, f: e.unique(Tables(s, f).bronze("SupplyChain"), "`Order Item Id`"),
        with_tables(
            'SELECT "Order Item Id" AS unique_field, COUNT(*) AS n_records FROM supply WHERE "Order Item Id" IS NOT NULL '
            "GROUP BY 1 HAVING COUNT(*) > 1",
            "supply",
        ),
    ),
    Entry("e68_project_suite", _suite, _suite_sql()),
    Entry("e68_schema_and_data_suite", _line_suite, _line_sql()),
    Entry("e68_suite_thresholds", _thresholds, _THRESHOLDS_SQL),
]
