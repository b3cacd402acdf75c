"""Mergeable states of the marts, day by day, that the dashboard reads.

A state holds sums that add up: the binned sums of :mod:`larder.functions.numbers` for money and rates, whole numbers for
quantities. Any range of days, any coarser group follows by adding states, with the very bits that the mart
itself would give. There is one row per day, store and category (one per day for compliance), however many rows a mart has; when
days change, only their states are made anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.numbers import sum_parts
from larder.operators.gold import by_family

# --- fixed values that results must agree on --------------------------------------

FAMILY_NAMES = {"FOODS": "Foods", "HOUSEHOLD": "Household", "HOBBIES": "Hobbies"}


def category_of(product_id, category_name):
    """Product family, else the product's category."""
    return by_family(product_id, FAMILY_NAMES, F.coalesce(category_name, F.lit("Other")))


def waste_states(waste: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """``date_id, store_id, category, value, unsold_qty, total_stock``: sums over the food waste mart.

    The mart's own categories serve: a family is known by its products' ids, and every other product has its category there.
    ``products``, if given, has other categories to use instead.
    """
    named = waste
    if products is not None:
        named = waste.drop("category_name").join(products.select("product_id", "category_name"), "product_id", "left")
    return named.groupBy("date_id", "store_id", category_of(F.col("product_id"), F.col("category_name")).alias("category")).agg(
        sum_parts(F.col("potential_waste_value")).alias("value"),
        F.sum("unsold_qty").alias("unsold_qty"),
        F.sum("total_stock").alias("total_stock"),
    )


def compliance_states(compliance: DataFrame) -> DataFrame:
    """``date_id, rate, rates, equipment_breach_count, devices``: sums over the cold-chain mart, the number of rates, and of devices."""
    return compliance.groupBy("date_id").agg(
        sum_parts(F.col("compliance_rate_pct")).alias("rate"),
        F.count("compliance_rate_pct").alias("rates"),
        F.sum("equipment_breach_count").alias("equipment_breach_count"),
        F.countDistinct("device_id").alias("devices"),
    )


def changed_days(states: DataFrame, mart: DataFrame, days: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The states with those of ``days`` (``date_id``; NULL is a day) made anew from the mart, which only they are read of.

    Days without rows in the mart lose their states. A calendar bounds the days, so they are broadcast.
    """
    day = F.broadcast(days.select(F.col("date_id").alias("_day")).distinct())
    same = F.col("date_id").eqNullSafe(F.col("_day"))
    kept = states.join(day, same, "left_anti")
    return kept.unionByName(build(mart.join(day, same, "left_semi")))
