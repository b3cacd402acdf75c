"""Queries of the statistical helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.entry import Entry
from larder.catalog.sqltext import rnd
from larder.catalog.tables import Tables
from larder.functions.numbers import log_natural, md5_text, random_uniform, regexp_match, rounded
from larder.operators.ordered import median, percentile_cont, running_sums


def _running(spark, sf):
    lines = Tables(spark, sf).raw("lineitem").select("l_orderkey", "l_suppkey", "l_shipdate", "l_linenumber")
    both = {"rolling_sum_increasing": False, "rolling_sum_decreasing": True}
    return running_sums(lines, "l_linenumber", ["l_suppkey"], "l_shipdate", both)


def _percentiles(spark, sf):
    lines = Tables(spark, sf).raw("lineitem")
    found = percentile_cont(lines, "l_extendedprice", 0.9, ["l_suppkey"])
    return found.select("l_suppkey", rounded(F.col("percentile"), 4).alias("percentile"))


def _median(spark, sf):
    found = median(Tables(spark, sf).raw("lineitem"), "l_extendedprice")
    return found.select(rounded(F.col("median"), 4).alias("median"))


def _log(spark, sf):
    lines = Tables(spark, sf).raw("lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", rounded(log_natural(F.col("l_quantity") - 1), 5).alias("log_quantity")
    )


def _random(spark, sf):
    return Tables(spark, sf).raw("lineitem").select("l_orderkey", random_uniform(7).alias("draw"))


def _random_range(spark, sf):
    drawn = _random(spark, sf).select("l_orderkey", ((F.col("draw") >= 0) & (F.col("draw") < 1)).alias("in_range"))
    return drawn.groupBy("l_orderkey", "in_range").agg(F.count(F.lit(1)).alias("draws"))


def _regex(spark, sf):
    text = F.col("text")
    return Tables(spark, sf).raw("documents").select(
        "doc_id",
        regexp_match(text, "[0-9]{3}-[0-9]{4}").alias("digits"),
        regexp_match(text, "^[a-z]+ THE", "i").alias("folded"),
        regexp_match(text, "^[a-z]+ THE", "c").alias("exact"),
    )


def _md5(spark, sf):
    return Tables(spark, sf).raw("orders").select(
        "o_orderkey", md5_text(F.col("o_orderkey")).alias("key_hash"), md5_text(F.col("o_orderpriority")).alias("text_hash")
    )


ENTRIES = [
    Entry(
        "x1_running_sum",
        _running,
        "SELECT l_orderkey, l_suppkey, l_shipdate, l_linenumber, "
        "CAST(SUM(l_linenumber) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate) AS BIGINT) AS rolling_sum_increasing, "
        "CAST(SUM(l_linenumber) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC) AS BIGINT) AS rolling_sum_decreasing FROM lineitem",
    ),
    Entry(
        "x2_percentile_cont",
        _percentiles,
        f"SELECT l_suppkey, {rnd('quantile_cont(l_extendedprice, 0.9)', 4)} AS percentile FROM lineitem GROUP BY 1",
    ),
    Entry("x2_median", _median, f"SELECT {rnd('median(l_extendedprice)', 4)} AS median FROM lineitem"),
    Entry(
        "x3_log_natural",
        _log,
        f"SELECT l_orderkey, l_linenumber, {rnd('ln(NULLIF(l_quantity - 1, 0))', 5)} AS log_quantity FROM lineitem",
    ),
    Entry("x4_rand", _random),
    Entry(
        "x4_rand_range",
        _random_range,
        "SELECT l_orderkey, true AS in_range, COUNT(*) AS draws FROM lineitem GROUP BY 1",
    ),
    Entry(
        "x5_regexp_match",
        _regex,
        "SELECT doc_id, regexp_matches(text, '[0-9]{3}-[0-9]{4}') AS digits, regexp_matches(text, '^[a-z]+ THE', 'i') AS folded, "
        "regexp_matches(text, '^[a-z]+ THE', 'c') AS exact FROM documents",
    ),
    Entry(
        "x6_md5",
        _md5,
        "SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS key_hash, md5(o_orderpriority) AS text_hash FROM orders",
    ),
]
