"""Staging and silver tables: typed, renamed, filtered and deduplicated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.dates import shift_date
from larder.functions.numbers import to_int
from larder.operators.calendar import day_sequence

# --- fixed values that results must agree on --------------------------------------

CATEGORY_NAMES = {
    "Cat_1": "Pantry & Dry Goods",
    "Cat_2": "Snacks & Sweets",
    "Cat_3": "Meat & Seafood",
    "Cat_4": "Canned Goods",
    "Cat_5": "Fresh Produce",
    "Cat_6": "Baking Needs",
    "Cat_7": "Breakfast & Cereal",
    "Cat_8": "Dairy & Eggs",
    "Cat_9": "Beverages",
    "Cat_10": "Condiments & Sauces",
    "Cat_11": "Deli & Cheese",
    "Cat_12": "Frozen Foods",
    "Cat_13": "Personal Care",
    "Cat_14": "Health & Wellness",
    "Cat_15": "Household Essentials",
    "Cat_16": "Baby Care",
    "Cat_17": "Pet Care",
    "Cat_18": "Paper Goods",
    "Cat_19": "Cleaning Supplies",
    "Cat_20": "Beauty & Cosmetics",
    "Cat_21": "Office & School Supplies",
    "Cat_22": "Electronics & Accessories",
    "Cat_23": "Home & Garden",
    "Cat_24": "Toys & Games",
    "Cat_25": "Apparel & Accessories",
    "Cat_26": "Bakery",
    "Cat_27": "Floral & Gifts",
    "Cat_28": "Prepared Foods (Ready-to-Eat)",
    "Cat_29": "Spices & Seasonings",
    "Cat_30": "International Foods",
}

STATE_NAMES = {"CA_": "California_", "TX_": "Texas_", "WI_": "Wisconsin_"}

STORE_NAMES = {"37": "Mumbai Central", "51": "Bangalore Square", "45": "Delhi North"}

FIRST_DAY = dt.date(2010, 1, 1)
LAST_DAY = dt.date(2030, 12, 31)

# --- row filters and staging --------------------------------------------------------


def non_null_key(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is present."""
    return df.filter(F.col(key).isNotNull())


def in_physical_range(df: DataFrame, column: str, low: float = -100, high: float = 100) -> DataFrame:
    """Rows with a reading inside the sensor's physical range; missing readings drop out."""
    return df.filter(F.col(column).between(low, high))


def where_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Equality scan; the predicate reaches the Parquet reader."""
    return df.filter(F.col(column) == F.lit(value))


def stg_instacart_grocery(bronze: DataFrame) -> DataFrame:
    """Typed basket lines with readable column names."""
    return bronze.select(
        F.col("order_id").cast("int").alias("order_id"),
        F.col("product_id").cast("int").alias("product_id"),
        F.col("add_to_cart_order").cast("int").alias("add_to_cart_order"),
        F.col("reordered").cast("boolean").alias("is_reordered"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("ingested_at"),
        F.col("_source_file").alias("source_file_path"),
    )


# --- dimensions ---------------------------------------------------------------------


def dim_date(
    spark: SparkSession | None = None,
    start: dt.date = FIRST_DAY,
    end: dt.date = LAST_DAY,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """One row per day from start to end, both included.

    ``bounds`` (one row with columns ``start`` and ``end``) takes the range from data.
    """
    day = F.col("date_id")
    return day_sequence(spark, start, end, bounds, name="date_id").select(
        "date_id",
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        F.day(day).cast("bigint").alias("day"),
        (F.dayofweek(day) - 1).cast("bigint").alias("day_of_week_num"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.quarter(day).cast("bigint").alias("quarter"),
    )


def category_label(category: Column) -> Column:
    """Readable category, else the raw one, else 'Uncategorized'."""
    pairs = [F.lit(x) for item in CATEGORY_NAMES.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[category], category, F.lit("Uncategorized"))


def dim_product(retail: DataFrame) -> DataFrame:
    """One row per product, taken from its most expensive sale.

    Equal prices are decided by the greater category, a missing one losing. Sales collapse
    to (product, category) first, a plain hash aggregate with map-side combine, so a
    best-seller never gathers its sales in one task.
    """
    by_category = (
        non_null_key(retail, "product_id")
        .groupBy(F.col("product_id").cast("string").alias("product_id"), "category_name")
        .agg(F.max(F.col("unit_price").cast("double")).alias("default_price"))
    )
    best = by_category.groupBy("product_id").agg(
        F.max(F.struct("default_price", "category_name")).alias("best")
    )
    return best.select(
        "product_id",
        category_label(F.col("best.category_name")).alias("category_name"),
        F.col("best.default_price").alias("default_price"),
        F.lit("Retail").alias("source_system"),
    )


def store_label(store_id: Column, city: Column) -> Column:
    """Display name of a store."""
    label = F.lit(None).cast("string")
    for number, name in STORE_NAMES.items():
        label = F.when(store_id == number, name).otherwise(label)
    for prefix, name in STATE_NAMES.items():
        label = F.when(store_id.like(prefix + "%"), F.replace(store_id, F.lit(prefix), F.lit(name))).otherwise(label)
    return F.coalesce(
        label, F.concat(city, F.lit(" Store")), F.concat(F.lit("Store "), store_id)
    )


def dim_store(retail: DataFrame, m5: DataFrame) -> DataFrame:
    """One row per store of either source, with the greatest known city and state."""
    no_text = F.lit(None).cast("string")
    sales = non_null_key(retail, "store_id").select(
        F.col("store_id").cast("string").alias("store_id"),
        F.col("store_city").alias("city"),
        no_text.alias("state"),
    )
    stock = non_null_key(m5, "store_id").select(
        F.col("store_id").cast("string").alias("store_id"),
        no_text.alias("city"),
        F.col("state_id").alias("state"),
    )
    stores = (
        sales.distinct()
        .union(stock.distinct())
        .groupBy("store_id")
        .agg(F.max("city").alias("city"), F.max("state").alias("state"))
    )
    return stores.select(
        "store_id", store_label(F.col("store_id"), F.col("city")).alias("store_name"), "city", "state"
    )


def dim_supplier(retail: DataFrame) -> DataFrame:
    """One active supplier per country, keyed by the country's MD5."""
    countries = non_null_key(retail, "supplier_country").select(F.col("supplier_country").alias("country"))
    return countries.distinct().select(
        F.md5("country").alias("supplier_id"), "country", F.lit("Active").alias("supplier_status")
    )


# --- facts --------------------------------------------------------------------------


def _whole_number(df: DataFrame, column: str) -> Column:
    """INT cast that rounds fractional input as the warehouse does; integers cast directly."""
    fractional = dict(df.dtypes)[column].startswith(("double", "float", "decimal"))
    value = F.col(f"`{column}`")
    return to_int(value) if fractional else value.cast("int")


def fact_sales(retail: DataFrame) -> DataFrame:
    """Sales lines; repeated lines stay."""
    return non_null_key(retail, "order_item_id").select(
        F.col("order_item_id").cast("string").alias("order_item_id"),
        F.col("order_id").cast("string").alias("order_id"),
        F.col("order_date").cast("date").alias("order_date_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("store_id").cast("string").alias("store_id"),
        F.col("product_id").cast("string").alias("product_id"),
        _whole_number(retail, "qty").alias("quantity"),
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("discount_applied").cast("double").alias("discount_amount"),
        F.col("total_order_payment").cast("double").alias("total_payment"),
        "shipment_status",
    )


def fact_inventory(m5: DataFrame, shift_years: int = 9, shift_months: int = 0) -> DataFrame:
    """Stock records, moved forward in time to overlap the sales."""
    return non_null_key(m5, "id").select(
        F.col("id").alias("inventory_record_id"),
        F.col("item_id").cast("string").alias("product_id"),
        F.col("store_id").cast("string").alias("store_id"),
        shift_date(F.col("date_std").cast("date"), shift_years, shift_months).cast("date").alias("date_id"),
        _whole_number(m5, "sales_qty").alias("stock_quantity"),
        F.col("sell_price").cast("double").alias("current_price"),
    )


def fact_purchase_order(supply: DataFrame) -> DataFrame:
    """Purchase-order lines; source column names hold spaces and parentheses."""
    return non_null_key(supply, "order_id").select(
        F.col("order_id").cast("string").alias("po_id"),
        F.col("order_date").cast("date").alias("order_date_id"),
        F.col("shipping_date").cast("date").alias("shipping_date_id"),
        _whole_number(supply, "order_quantity").alias("order_qty"),
        F.col("sales_amount").cast("double").alias("sales_amount"),
        _whole_number(supply, "Days for shipping (real)").alias("actual_shipping_days"),
        _whole_number(supply, "Days for shipment (scheduled)").alias("scheduled_shipping_days"),
        F.col("`Delivery Status`").alias("delivery_status"),
        F.col("Late_delivery_risk").cast("boolean").alias("is_late_risk"),
        F.col("`Shipping Mode`").alias("shipping_mode"),
    )


def fact_cold_chain(iot: DataFrame, shift_years: int = 0, shift_months: int = 0) -> DataFrame:
    """Sensor readings inside the physical range."""
    time = shift_date(F.col("timestamp").cast("timestamp_ntz"), shift_years, shift_months)
    return in_physical_range(iot, "temp_celsius").select(
        time.alias("telemetry_timestamp"),
        time.cast("date").alias("date_id"),
        F.col("device_mac").alias("device_id"),
        F.col("temp_celsius").cast("double").alias("temperature_c"),
        F.col("humidity_pct").cast("double").alias("humidity_percentage"),
        F.col("co_level").cast("double").alias("co_level"),
        F.col("smoke_level").cast("double").alias("smoke_level"),
        F.col("is_light").cast("boolean").alias("is_light_on"),
        F.col("is_motion").cast("boolean").alias("is_motion_detected"),
    )
