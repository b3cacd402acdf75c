"""Staging and silver queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.entry import Entry
from larder.catalog.sqltext import with_tables
from larder.catalog.tables import Tables
from larder.functions.dates import shift_date
from larder.operators import silver
from larder.session import work_path
from larder.sources import lenses
from larder.sources.tables import Lake

_RETAIL = (
    "order_item_id, order_id, order_date, customer_id, store_id, product_id, category_name, qty, unit_price, "
    "discount_applied, total_order_payment, shipment_status, store_city, supplier_country"
)
_RETAIL_LIST = _RETAIL.split(", ")
#: The device that an equality scan looks for.
DEVICE = "dev-1"
#: The order line that an equality scan looks for.
ITEM = "13"


def _stored(spark, sf, name: str, columns, bloom=()) -> Lake:
    """A lake that holds one bronze table as a loader leaves it."""
    lake = Lake(spark, work_path(spark, "lake"))
    rows = Tables(spark, sf).bronze(name).select(*(F.col(f"`{c}`") for c in columns), "_loaded_at", "_source_file")
    lake.write(rows, "bronze", name, bloom=bloom)
    return lake


def _staged(bronze: str, columns):
    """A stored bronze table passed through; the time of loading differs from run to run."""
    return lambda spark, sf: _stored(spark, sf, bronze, columns).stg_passthrough(bronze).drop("_loaded_at")


def _grocery(spark, sf):
    return silver.stg_instacart_grocery(Tables(spark, sf).bronze("instacart_grocery"))


def _non_null(spark, sf):
    retail = Tables(spark, sf).retail
    return silver.non_null_key(retail, "category_name").select("order_item_id", "category_name")


def _range(spark, sf):
    iot = Tables(spark, sf).bronze("iot_telemetry")
    return silver.in_physical_range(iot, "temp_celsius").select("timestamp", "device_mac", "temp_celsius")


def _quoted(spark, sf):
    supply = Tables(spark, sf).bronze("SupplyChain")
    names = ["Order Item Id", "Days for shipping (real)", "Days for shipment (scheduled)", "Delivery Status", "Shipping Mode"]
    return supply.select(*(F.col(f"`{n}`") for n in names))


def equality_scan(spark, sf):
    """Readings of one device, by a predicate that the stored table's Parquet reader takes."""
    readings = _stored(spark, sf, "iot_telemetry", lenses.IOT_COLUMNS).read("bronze", "iot_telemetry")
    return silver.where_equal(readings, "device_mac", DEVICE).select("timestamp", "device_mac", "temp_celsius")


def bloom_scan(spark, sf):
    """The basket line of one id, in a stored table where ids lie in no order and only Bloom filters can skip row groups."""
    lines = _stored(spark, sf, "retail_data", _RETAIL_LIST, bloom=["order_item_id"]).read("bronze", "retail_data")
    return silver.where_equal(lines, "order_item_id", ITEM).select("order_item_id", "order_id", "product_id", "qty")


def _equality_sales(spark, sf):
    sales = Tables(spark, sf).sales
    return silver.where_equal(sales, "store_id", "CA_1").select("order_item_id", "store_id", "quantity")


def _shift(spark, sf):
    orders = Tables(spark, sf).raw("orders")
    day = F.col("o_orderdate").cast("date")
    return orders.select(
        "o_orderkey",
        shift_date(day, 5, 10).alias("shifted_date"),
        shift_date(F.col("o_orderdate"), 5, 10).alias("shifted_time"),
        shift_date(day, 9).alias("plus_nine_years"),
    )


def _inventory_shifted(spark, sf):
    return silver.fact_inventory(Tables(spark, sf).m5)


ENTRIES = [
    *(
        Entry(
            f"p1_stg_{name}",
            _staged(bronze, columns),
            with_tables(f"SELECT {shown}, '{file}.parquet' AS _source_file FROM {source}", source),
        )
        for name, bronze, columns, shown, file, source in (
            ("retail_data", "retail_data", _RETAIL_LIST, _RETAIL, "lineitem", "retail"),
            ("iot_telemetry", "iot_telemetry", lenses.IOT_COLUMNS, "*", "events", "iot"),
            ("m5_forcasting", "m5_forcasting", lenses.M5_COLUMNS, "*", "lineitem", "m5"),
            ("supply_chain", "SupplyChain", lenses.SUPPLY_COLUMNS, "*", "lineitem", "supply"),
        )
    ),
    Entry(
        "p2_stg_instacart_grocery",
        _grocery,
        with_tables(
            "SELECT CAST(order_id AS INTEGER) AS order_id, CAST(product_id AS INTEGER) AS product_id, "
            "CAST(add_to_cart_order AS INTEGER) AS add_to_cart_order, CAST(reordered AS BOOLEAN) AS is_reordered, "
            "CAST(_loaded_at AS TIMESTAMP) AS ingested_at, _source_file AS source_file_path FROM grocery",
            "grocery",
        ),
    ),
    Entry(
        "p3_non_null_key",
        _non_null,
        with_tables(
            "SELECT order_item_id, category_name FROM retail WHERE category_name IS NOT NULL", "retail"
        ),
    ),
    Entry(
        "p4_physical_range",
        _range,
        with_tables(
            "SELECT timestamp, device_mac, temp_celsius FROM iot WHERE temp_celsius BETWEEN -100 AND 100", "iot"
        ),
    ),
    Entry(
        "p5_quoted_columns",
        _quoted,
        with_tables(
            'SELECT "Order Item Id", "Days for shipping (real)", "Days for shipment (scheduled)", '
            '"Delivery Status", "Shipping Mode" FROM supply',
            "supply",
        ),
    ),
    Entry(
        "p6_equality_scan_stored",
        equality_scan,
        with_tables(f"SELECT timestamp, device_mac, temp_celsius FROM iot WHERE device_mac = '{DEVICE}'", "iot"),
    ),
    Entry(
        "p6_equality_scan_bloom",
        bloom_scan,
        with_tables(f"SELECT order_item_id, order_id, product_id, qty FROM retail WHERE order_item_id = '{ITEM}'", "retail"),
    ),
    Entry(
        "p6_equality_scan",
        _equality_sales,
        with_tables("SELECT order_item_id, store_id, quantity FROM fact_sales WHERE store_id = 'CA_1'", "fact_sales"),
    ),
    Entry(
        "p7_shift_date",
        _shift,
        "SELECT o_orderkey, "
        "CAST(CAST(o_orderdate AS DATE) + INTERVAL 5 YEAR + INTERVAL 10 MONTH AS DATE) AS shifted_date, "
        "o_orderdate + INTERVAL 5 YEAR + INTERVAL 10 MONTH AS shifted_time, "
        "CAST(CAST(o_orderdate AS DATE) + INTERVAL 9 YEAR AS DATE) AS plus_nine_years FROM orders",
    ),
    Entry("v1_dim_date", lambda s, d: Tables(s, d).order_days, with_tables("SELECT * FROM dim_date", "dim_date")),
    Entry("v2_dim_product", lambda s, d: Tables(s, d).products, with_tables("SELECT * FROM dim_product", "dim_product")),
    Entry("v3_dim_store", lambda s, d: Tables(s, d).stores, with_tables("SELECT * FROM dim_store", "dim_store")),
    Entry(
        "v4_dim_supplier",
        lambda s, d: silver.dim_supplier(Tables(s, d).retail),
        with_tables(
            "SELECT MD5(country) AS supplier_id, country, supplier_status FROM (SELECT DISTINCT supplier_country "
            "AS country, 'Active' AS supplier_status FROM retail WHERE supplier_country IS NOT NULL)",
            "retail",
        ),
    ),
    Entry("v5_fact_sales", lambda s, d: Tables(s, d).sales, with_tables("SELECT * FROM fact_sales", "fact_sales")),
    Entry(
        "v6_fact_inventory",
        lambda s, d: Tables(s, d).inventory,
        with_tables("SELECT * FROM fact_inventory", "fact_inventory"),
    ),
    Entry(
        "v6_fact_inventory_shifted",
        _inventory_shifted,
        with_tables(
            "SELECT * REPLACE (CAST(date_id + INTERVAL 9 YEAR AS DATE) AS date_id) FROM fact_inventory",
            "fact_inventory",
        ),
    ),
    Entry(
        "v7_fact_purchase_order",
        lambda s, d: Tables(s, d).purchase_orders,
        with_tables("SELECT * FROM fact_purchase_order", "fact_purchase_order"),
    ),
    Entry(
        "v8_fact_cold_chain",
        lambda s, d: Tables(s, d).readings,
        with_tables("SELECT * FROM fact_cold_chain", "fact_cold_chain"),
    ),
    Entry(
        "v8_fact_cold_chain_shifted",
        lambda s, d: silver.fact_cold_chain(Tables(s, d).bronze("iot_telemetry"), 5, 10),
        with_tables(
            "SELECT * REPLACE (telemetry_timestamp + INTERVAL 5 YEAR + INTERVAL 10 MONTH AS telemetry_timestamp, "
            "CAST(telemetry_timestamp + INTERVAL 5 YEAR + INTERVAL 10 MONTH AS DATE) AS date_id) FROM fact_cold_chain",
            "fact_cold_chain",
        ),
    ),
]
