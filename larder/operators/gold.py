"""Gold marts: food waste, cold-chain compliance, executive KPIs, suppliers, demand.

Facts are aggregated before any join. What is joined by day has one row per calendar day,
so its size is bounded by the calendar and broadcasting it is safe; products and stores
are left to adaptive execution, which broadcasts them when their measured size allows and
otherwise sorts, splitting hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.numbers import exact_avg, exact_sum, rounded

# --- fixed values that results must agree on --------------------------------------

CURRENCY_FACTOR = 15000
FLAT_STOCK = 1000
HIGH_WASTE_PCT = 20
MODERATE_WASTE_PCT = 5
FAMILY_CATEGORIES = {
    "FOODS": "Food & Beverage",
    "HOUSEHOLD": "Household & Cleaning",
    "HOBBIES": "Hobbies & Toys",
}
FAMILY_PRICES = {"FOODS": 15.0, "HOUSEHOLD": 25.0, "HOBBIES": 40.0}
DEFAULT_PRICE = 10.0
NORMAL_Z80 = 1.28

WASTE_COLUMNS = [
    "total_stock",
    "total_sold",
    "unsold_qty",
    "potential_waste_value",
    "waste_rate_pct",
    "waste_rate_status",
]


def by_family(product_id: Column, labels: dict, otherwise: Column) -> Column:
    """A value chosen by the product id's family prefix."""
    chosen = otherwise
    for prefix, label in labels.items():
        chosen = F.when(product_id.startswith(prefix), F.lit(label)).otherwise(chosen)
    return chosen


def month_of(day: Column) -> Column:
    """First day of the month."""
    return F.trunc(day, "month")


def _sum_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


# --- food waste ----------------------------------------------------------------------


def _stock(inventory: DataFrame) -> DataFrame:
    """Stock and mean price per day, product and store."""
    return inventory.groupBy("date_id", "product_id", "store_id").agg(
        F.sum("stock_quantity").alias("total_stock"),
        exact_avg(F.col("current_price")).alias("avg_price"),
    )


def _waste_measures(df: DataFrame, price: Column, factor: int = 1) -> DataFrame:
    """Unsold quantity, its value, and the waste rate with its status."""
    stock, unsold = F.col("total_stock"), F.col("unsold_qty")
    rate = unsold * F.lit(100.0) / F.nullif(stock, F.lit(0))
    status = (
        F.when(stock == 0, "No Stock")
        .when(rate > HIGH_WASTE_PCT, "High Waste Risk")
        .when(rate > MODERATE_WASTE_PCT, "Moderate Risk")
        .otherwise("Healthy")
    )
    return df.withColumn("unsold_qty", F.greatest(stock - F.col("total_sold"), F.lit(0))).withColumns(
        {
            "potential_waste_value": unsold * price * factor,
            "waste_rate_pct": F.when(stock == 0, F.lit(0.0)).otherwise(rounded(rate, 2)),
            "waste_rate_status": status,
        }
    )


def food_waste(
    sales: DataFrame,
    products: DataFrame,
    inventory: DataFrame | None = None,
    stores: DataFrame | None = None,
    method: str = "spread",
) -> DataFrame:
    """Unsold stock per day, store and product, by one of three methods.

    ``spread``: a day's total sales are divided evenly over the day's stock rows.
    ``keyed``: sales and stock meet on day, product and store.
    ``flat_stock``: no inventory, every sold product counts a stock of 1000.
    """
    if method == "spread":
        return _waste_spread(sales, products, inventory, stores)
    if method == "keyed":
        return _waste_keyed(sales, products, inventory)
    if method == "flat_stock":
        return _waste_flat_stock(sales, products)
    raise ValueError(f"unknown method: {method}")


def _waste_spread(sales, products, inventory, stores) -> DataFrame:
    stock = _stock(inventory)
    sold_per_day = sales.groupBy(F.col("order_date_id").alias("date_id")).agg(F.sum("quantity").alias("sold"))
    # All rows, counted over every column of the stock: with the keys alone Spark would shuffle the inventory a second time.
    alike = F.col("total_stock").isNull() == F.col("avg_price").isNull()
    rows_per_day = stock.groupBy("date_id").agg((F.count_if(alike) + F.count_if(~alike)).alias("stock_rows"))
    share = F.round(F.col("sold") / F.col("stock_rows")).cast("bigint")
    # One row per calendar day. A row without a day has no share; the joins do not filter such rows, which would
    # make the stock counted here another one than the stock below.
    daily_share = rows_per_day.join(F.broadcast(sold_per_day), "date_id", "left").select(
        F.col("date_id").alias("_day"), share.alias("day_share")
    )
    product = F.col("product_id")
    price = F.coalesce("avg_price", "default_price", by_family(product, FAMILY_PRICES, F.lit(DEFAULT_PRICE)))
    joined = (
        stock.join(F.broadcast(daily_share), F.col("date_id").eqNullSafe(F.col("_day")), "left")
        .join(products.select("product_id", "category_name", "default_price"), "product_id", "left")
        .join(stores.select("store_id", "store_name"), "store_id", "left")
        .withColumn("total_sold", F.coalesce("day_share", F.lit(0).cast("bigint")))
        .withColumn(
            "category_name",
            by_family(product, FAMILY_CATEGORIES, F.coalesce("category_name", F.lit("Other"))),
        )
    )
    return _waste_measures(joined, price, CURRENCY_FACTOR).select(
        "date_id", "store_id", "store_name", "product_id", "category_name", *WASTE_COLUMNS
    )


def _waste_keyed(sales, products, inventory) -> DataFrame:
    # Both sides have the same key, so one grouping of both takes the place of two and a sorted join. Missing keys never meet.
    keys = ["date_id", "product_id", "store_id"]
    sold = sales.select(
        F.col("order_date_id").alias("date_id"), "product_id", "store_id", F.col("quantity").alias("sold")
    ).dropna(subset=keys)
    stocked = inventory.select(*keys, F.lit(True).alias("stocked"), "stock_quantity", "current_price")
    joined = (
        stocked.unionByName(sold, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(
            F.max("stocked").alias("stocked"),
            F.sum("stock_quantity").alias("total_stock"),
            exact_avg(F.col("current_price")).alias("avg_price"),
            F.sum("sold").alias("sold"),
        )
        .filter("stocked")
        .join(products.select("product_id", "category_name"), "product_id", "left")
        .withColumn("total_sold", F.coalesce("sold", F.lit(0).cast("bigint")))
    )
    return _waste_measures(joined, F.col("avg_price")).select(
        "date_id", "store_id", "product_id", "category_name", *WASTE_COLUMNS
    )


def _waste_flat_stock(sales, products) -> DataFrame:
    # Products are unique per id, so their category follows after the aggregation.
    sold = sales.groupBy(F.col("order_date_id").alias("date_id"), "store_id", "product_id").agg(
        F.sum("quantity").alias("total_sold"), F.max("unit_price").alias("price")
    )
    unsold = F.greatest(F.lit(FLAT_STOCK) - F.col("total_sold"), F.lit(0))
    return sold.join(products.select("product_id", "category_name"), "product_id", "left").select(
        "date_id",
        "store_id",
        "product_id",
        "category_name",
        F.lit(FLAT_STOCK).alias("total_stock"),
        "total_sold",
        unsold.alias("unsold_qty"),
        (unsold * F.col("price")).alias("potential_waste_value"),
        (unsold * F.lit(100.0) / FLAT_STOCK).alias("waste_rate_pct"),
        F.lit("High").alias("waste_rate_status"),
    )


# --- cold chain ----------------------------------------------------------------------


def cold_chain_compliance(anomalies: DataFrame) -> DataFrame:
    """Compliance per day and device from labelled readings.

    The type looks at the mean temperature of all readings of the day.
    """
    daily = anomalies.groupBy(F.col("telemetry_timestamp").cast("date").alias("date_id"), "device_id").agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.sum("equipment_breach").cast("bigint").alias("equipment_breach_count"),
        exact_avg(F.col("compliance_rate_pct")).alias("compliance"),
        exact_avg(F.col("temperature_c")).alias("mean_temperature"),
    )
    kind = (
        F.when(F.col("equipment_breach_count") == 0, "Normal (No Anomaly)")
        .when(F.col("mean_temperature") > 5.0, "Temperature Breach")
        .otherwise("Humidity / Unknown Anomaly")
    )
    return daily.select(
        "date_id",
        "device_id",
        "total_readings",
        "equipment_breach_count",
        rounded(F.col("compliance"), 2).alias("compliance_rate_pct"),
        kind.alias("anomaly_type_dominant"),
    )


def cold_chain_daily_threshold(readings: DataFrame, limit: float = 5.0) -> DataFrame:
    """Temperature and humidity per day and device, with readings above the limit."""
    temperature = F.col("temperature_c")
    daily = readings.groupBy("date_id", "device_id").agg(
        rounded(exact_avg(temperature), 2).alias("avg_temp_c"),
        rounded(F.max(temperature), 2).alias("max_temp_c"),
        rounded(F.min(temperature), 2).alias("min_temp_c"),
        rounded(exact_avg(F.col("humidity_percentage")), 2).alias("avg_humidity_pct"),
        _sum_if(temperature > limit).alias("temperature_violations"),
    )
    violated = F.col("temperature_violations") > 0
    return daily.withColumn(
        "daily_compliance_status", F.when(violated, "Non-Compliant").otherwise("Compliant")
    )


def cold_chain_breach_rate(readings: DataFrame, limit: float = 30) -> DataFrame:
    """Share of readings within the limit per day and device."""
    daily = readings.groupBy("date_id", "device_id").agg(
        F.count(F.lit(1)).alias("total_readings"),
        _sum_if(F.col("temperature_c") > limit).alias("equipment_breach_count"),
    )
    rate = F.lit(100.0) - F.col("equipment_breach_count") * F.lit(100.0) / F.col("total_readings")
    return daily.withColumns({"compliance_rate_pct": rate, "anomaly_type_dominant": F.lit("Temperature")})


# --- executive, supplier and demand marts ---------------------------------------------


def _monthly_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy(month_of(F.col("order_date_id")).alias("kpi_month")).agg(
        exact_sum(F.col("total_payment")).alias("total_revenue"),
        F.sum("quantity").alias("total_items_sold"),
    )


def executive_kpi(sales: DataFrame, waste: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Monthly revenue and items with waste value and breaches; months without sales are absent."""
    monthly_waste = waste.groupBy(month_of(F.col("date_id")).alias("kpi_month")).agg(
        exact_sum(F.col("potential_waste_value")).alias("waste_value")
    )
    monthly_breaches = anomalies.groupBy(
        month_of(F.col("telemetry_timestamp").cast("date")).alias("kpi_month")
    ).agg(F.sum("equipment_breach").cast("bigint").alias("breaches"))
    return (
        _monthly_sales(sales)
        .join(F.broadcast(monthly_waste), "kpi_month", "left")
        .join(F.broadcast(monthly_breaches), "kpi_month", "left")
        .select(
            "kpi_month",
            "total_revenue",
            "total_items_sold",
            F.coalesce("waste_value", F.lit(0.0)).alias("total_potential_waste_value"),
            F.coalesce("breaches", F.lit(0).cast("bigint")).alias("total_temp_violations"),
        )
    )


def executive_kpi_sales_only(sales: DataFrame) -> DataFrame:
    """Monthly revenue and items with the other two metrics fixed at zero."""
    return _monthly_sales(sales).withColumns(
        {"total_potential_waste_value": F.lit(0), "total_temp_violations": F.lit(0)}
    )


def supplier_performance(orders: DataFrame) -> DataFrame:
    """Shipments, late share and mean delay per month and shipping mode.

    Early, punctual and unknown deliveries count as zero delay.
    """
    delay = F.col("actual_shipping_days") - F.col("scheduled_shipping_days")
    late = _sum_if(F.col("is_late_risk"))
    shipments = F.count(F.lit(1))
    return orders.groupBy(month_of(F.col("order_date_id")).alias("performance_month"), "shipping_mode").agg(
        shipments.alias("total_shipments"),
        late.alias("total_late_shipments"),
        rounded(late / shipments * 100, 2).alias("late_delivery_rate_pct"),
        rounded(F.sum(F.when(delay > 0, delay).otherwise(0)) / shipments, 2).alias("avg_delay_days"),
    )


def demand_baseline(sales: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Daily demand per product and store with its mean, 80 % bounds and error share.

    Sales are reduced to one row per day, product and store first, so the window over a
    product's days holds at most one row per calendar day, even for a best-seller. These rows are dealt by product
    once, which serves the window and the join of products alike.
    """
    keys = ["product_id", "store_id"]
    qty = F.col("daily_sales_qty")
    days = Window.partitionBy(*keys)
    daily = (
        sales.groupBy(F.col("order_date_id").alias("date_id"), *keys)
        .agg(
            F.sum("quantity").alias("daily_sales_qty"),
            exact_sum(F.col("total_payment")).alias("daily_revenue"),
            F.countDistinct("order_id").alias("total_orders"),
        )
        .repartition("product_id")
        .withColumns(
            {
                "mean": F.sum(qty).over(days) / F.count(qty).over(days),
                "spread": F.stddev_samp(qty).over(days),
            }
        )
    )
    margin = F.lit(NORMAL_Z80) * F.coalesce("spread", F.lit(0.0))
    error = rounded(F.abs(qty - F.col("mean")) / F.nullif(qty, F.lit(0)), 4)
    return (
        # The dates table has one row per calendar day.
        daily.join(F.broadcast(dates.select("date_id", "year", "month", "day_name")), "date_id")
        .join(products.select("product_id", "category_name"), "product_id", "left")
        .select(
            "date_id",
            "year",
            "month",
            "day_name",
            "store_id",
            "product_id",
            "category_name",
            "daily_sales_qty",
            "daily_revenue",
            "total_orders",
            rounded(F.col("mean"), 2).alias("forecast_qty"),
            rounded(F.col("mean") - margin, 2).alias("lower_bound_80"),
            rounded(F.col("mean") + margin, 2).alias("upper_bound_80"),
            F.when(qty == 0, F.lit(0.0)).otherwise(error).alias("mape_contribution"),
        )
    )


def daily_demand(sales: DataFrame) -> DataFrame:
    """Sold quantity per day."""
    return sales.groupBy(F.col("order_date_id").alias("date_id")).agg(
        F.sum("quantity").alias("daily_sales_qty")
    )


def training_series(demand: DataFrame) -> DataFrame:
    """The forecasting input: one row per known day in ascending order."""
    return (
        demand.filter(F.col("date_id").isNotNull())
        .groupBy(F.col("date_id").alias("ds"))
        .agg(F.sum("daily_sales_qty").alias("y"))
        .orderBy("ds")
    )
