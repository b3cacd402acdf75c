"""Dashboard queries over the gold marts, or over their stored states. Date ranges include both ends.

Every query takes the mart itself or what :mod:`larder.operators.states` keeps of it, and gives the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.numbers import merged_parts, parts_rounded, parts_value, rounded, rounded_sum, sum_parts
from larder.operators.gold import month_of
from larder.operators.states import category_of


def between(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Rows of a date range; an open side does not filter."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(str(end)).cast("date"))
    return df


def _waste_rate() -> Column:
    return rounded(F.sum("unsold_qty") * F.lit(100.0) / F.nullif(F.sum("total_stock"), F.lit(0)), 2)


def _loss(waste: DataFrame) -> Column:
    parts = merged_parts(F.col("value")) if "value" in waste.columns else sum_parts(F.col("potential_waste_value"))
    return parts_rounded(parts, 2)


def _mean_rate(compliance: DataFrame) -> Column:
    stored = "rates" in compliance.columns
    total = merged_parts(F.col("rate")) if stored else sum_parts(F.col("compliance_rate_pct"))
    number = F.sum("rates") if stored else F.count("compliance_rate_pct")
    return rounded(parts_value(total) / F.nullif(number, F.lit(0)), 2)


def _devices(compliance: DataFrame) -> Column:
    """Devices of a day."""
    return F.max("devices") if "devices" in compliance.columns else F.countDistinct("device_id")


def kpi_waste(waste: DataFrame, start=None, end=None) -> DataFrame:
    """Overall waste rate and loss."""
    return between(waste, "date_id", start, end).agg(
        _waste_rate().alias("food_waste_rate_pct"), _loss(waste).alias("total_loss_value")
    )


def kpi_cold_chain(compliance: DataFrame, start=None, end=None) -> DataFrame:
    """Mean compliance and number of breaches."""
    return between(compliance, "date_id", start, end).agg(
        _mean_rate(compliance).alias("cold_chain_compliance_rate_pct"),
        F.sum("equipment_breach_count").alias("total_breaches"),
    )


def kpi_revenue(kpi: DataFrame, start=None, end=None) -> DataFrame:
    """Revenue over a range of months."""
    return between(kpi, "kpi_month", start, end).agg(
        rounded_sum(F.col("total_revenue"), 2).alias("total_revenue")
    )


def waste_trend(waste: DataFrame, grain: str = "month", start=None, end=None) -> DataFrame:
    """Waste rate and loss over time, by month or day."""
    day = F.col("date_id")
    period = {"month": month_of(day).alias("month"), "day": day}[grain]
    name = "month" if grain == "month" else "date_id"
    return (
        between(waste, "date_id", start, end)
        .groupBy(period)
        .agg(_waste_rate().alias("food_waste_rate_pct"), _loss(waste).alias("total_loss_value"))
        .orderBy(name)
    )


def waste_by_category(waste: DataFrame, products: DataFrame | None = None, start=None, end=None) -> DataFrame:
    """Loss per product family or category, greatest first; the mart itself needs the product table, its states don't.

    Waste is summed per product before the product table joins, so a hot product is one row.
    """
    rows = between(waste, "date_id", start, end)
    if "category" not in waste.columns:
        per_product = rows.groupBy("product_id").agg(
            sum_parts(F.col("potential_waste_value")).alias("value"),
            F.sum("unsold_qty").alias("unsold_qty"),
            F.sum("total_stock").alias("total_stock"),
        )
        named = per_product.join(products.select("product_id", "category_name"), "product_id", "left")
        rows = named.withColumn("category", category_of(F.col("product_id"), F.col("category_name")))
    return (
        rows.groupBy("category")
        .agg(
            parts_rounded(merged_parts(F.col("value")), 2).alias("total_loss_value"),
            _waste_rate().alias("waste_rate_pct"),
            F.sum("unsold_qty").alias("total_unsold_qty"),
        )
        .orderBy(F.desc("total_loss_value"), "category")
    )


def breach_timeline(compliance: DataFrame) -> DataFrame:
    """Breaches, mean compliance and devices per day."""
    return (
        compliance.groupBy("date_id")
        .agg(
            F.sum("equipment_breach_count").alias("total_breaches"),
            _mean_rate(compliance).alias("avg_compliance_rate_pct"),
            _devices(compliance).alias("devices_monitored"),
        )
        .orderBy("date_id")
    )


def top_locations(waste: DataFrame, stores: DataFrame, n: int = 5, start=None, end=None) -> DataFrame:
    """The ``n`` stores losing most; equal losses are ordered by store id."""
    per_store = (
        between(waste, "date_id", start, end)
        .groupBy("store_id")
        .agg(
            _loss(waste).alias("total_loss_value"),
            _waste_rate().alias("waste_rate_pct"),
            F.sum("unsold_qty").alias("total_unsold_qty"),
        )
    )
    named = per_store.join(stores.select("store_id", "store_name", "city", "state"), "store_id", "left")
    return (
        named.select(
            "store_id",
            F.coalesce("store_name", F.concat(F.lit("Store "), F.col("store_id"))).alias("store_name"),
            F.coalesce("city", "state", F.lit("Unknown")).alias("location"),
            "total_loss_value",
            "waste_rate_pct",
            "total_unsold_qty",
        )
        .orderBy(F.desc("total_loss_value"), "store_id")
        .limit(n)
    )


def forecast_window(forecast: DataFrame, start=None, end=None) -> DataFrame:
    """Forecast days of a range with whole-number quantities."""
    days = forecast.select(
        F.col("ds").cast("date").alias("date_id"),
        rounded(F.col("forecast_qty"), 0).alias("forecast_unit"),
        rounded(F.col("lower_bound"), 0).alias("lower_bound"),
        rounded(F.col("upper_bound"), 0).alias("upper_bound"),
    )
    return between(days, "date_id", start, end).orderBy("date_id")


def compliance_by_month(compliance: DataFrame, since=None) -> DataFrame:
    """Mean compliance and breaches per month."""
    return (
        between(compliance, "date_id", since)
        .groupBy(month_of(F.col("date_id")).alias("month"))
        .agg(_mean_rate(compliance).alias("avg_compliance"), F.sum("equipment_breach_count").alias("total_breaches"))
        .orderBy("month")
    )


def date_profile(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """First day, last day and row count per table; values are (frame, date column)."""
    profiles = [
        df.agg(
            F.min(F.col(column).cast("date")).alias("min_date"),
            F.max(F.col(column).cast("date")).alias("max_date"),
            F.count(F.lit(1)).alias("row_count"),
        ).select(F.lit(name).alias("table_name"), "min_date", "max_date", "row_count")
        for name, (df, column) in tables.items()
    ]
    return reduce(DataFrame.unionByName, profiles)


def date_overlap(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """The range of days that all tables cover."""
    return date_profile(tables).agg(
        F.max("min_date").alias("overlap_start"), F.min("max_date").alias("overlap_end")
    )
