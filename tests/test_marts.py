"""Silver, gold and dashboard edge cases the test data does not contain."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.functions.numbers import log_natural, rounded, to_int
from larder.operators import dashboard as q
from larder.operators import expectations as e
from larder.operators import gold, silver, states

D = dt.date


@pytest.fixture(scope="module")
def tables(spark):
    sales = spark.createDataFrame(
        [
            ("1", "o1", D(2024, 1, 1), "FOODS_1", "CA_1", 7, 2.0, 14.0),
            ("2", "o1", D(2024, 1, 1), "9", "37", 3, 5.0, 15.0),
            ("3", "o2", D(2024, 2, 1), "FOODS_1", "CA_1", 2000, 2.5, 10.0),
            ("4", "o3", None, "FOODS_1", "CA_1", 1, 2.5, 10.0),
        ],
        "order_item_id string, order_id string, order_date_id date, product_id string, store_id string, "
        "quantity int, unit_price double, total_payment double",
    )
    stock = spark.createDataFrame(
        [
            (D(2024, 1, 1), "FOODS_1", "CA_1", 10, 3.0),
            (D(2024, 1, 1), "FOODS_1", "CA_1", 10, None),
            (D(2024, 1, 1), "HOBBIES_7", "CA_1", 6, None),
            (D(2024, 1, 1), "9", "37", 0, None),
            (D(2024, 3, 1), "8", "zz", 4, None),
        ],
        "date_id date, product_id string, store_id string, stock_quantity int, current_price double",
    )
    products = spark.createDataFrame(
        [("FOODS_1", "Bakery", 9.0), ("9", "Cat_77", 5.0)], "product_id string, category_name string, default_price double"
    )
    stores = spark.createDataFrame([("CA_1", "California_1", None, "CA"), ("37", "Mumbai Central", "Mumbai", None)],
                                   "store_id string, store_name string, city string, state string")
    return sales, products, stock, stores


def test_waste_spread(tables):
    waste = {(r.product_id, r.store_id): r for r in gold.food_waste(*tables).collect()}
    # ten sold that day over three stock rows: three each
    food = waste["FOODS_1", "CA_1"]
    assert (food.total_stock, food.total_sold, food.unsold_qty, food.potential_waste_value) == (20, 3, 17, 17 * 3.0 * 15000)
    assert (food.waste_rate_pct, food.waste_rate_status, food.category_name) == (85.0, "High Waste Risk", "Food & Beverage")
    hobby = waste["HOBBIES_7", "CA_1"]
    assert (hobby.potential_waste_value, hobby.category_name, hobby.waste_rate_pct) == (3 * 40.0 * 15000, "Hobbies & Toys", 50.0)
    empty = waste["9", "37"]
    assert (empty.waste_rate_status, empty.waste_rate_pct, empty.unsold_qty, empty.category_name) == ("No Stock", 0.0, 0, "Cat_77")
    # nothing sold that day, no product, no store
    lone = waste["8", "zz"]
    assert (lone.total_sold, lone.potential_waste_value, lone.category_name, lone.store_name) == (0, 4 * 10.0 * 15000, "Other", None)


def test_waste_other_methods(tables):
    sales, products, stock, _ = tables
    keyed = {(r.product_id, r.date_id): r for r in gold.food_waste(sales, products, stock, method="keyed").collect()}
    food = keyed["FOODS_1", D(2024, 1, 1)]
    assert (food.total_sold, food.unsold_qty, food.potential_waste_value) == (7, 13, 39.0)
    assert keyed["HOBBIES_7", D(2024, 1, 1)].potential_waste_value is None
    flat = gold.food_waste(sales, products, method="flat_stock")
    rows = {(r.product_id, r.date_id): r for r in flat.collect()}
    assert rows["FOODS_1", D(2024, 2, 1)].unsold_qty == 0
    assert rows["9", D(2024, 1, 1)].potential_waste_value == 997 * 5.0
    # its status is not among the accepted ones
    allowed = ["Healthy", "Moderate Risk", "High Waste Risk", "No Stock"]
    assert e.expect_column_values_to_be_in_set(flat, "waste_rate_status", allowed).count() == 4
    with pytest.raises(ValueError):
        gold.food_waste(sales, products, method="other")


def test_kpi_months(spark, tables):
    sales, *_ = tables
    readings = spark.createDataFrame(
        [(dt.datetime(2024, 1, 5), 1), (dt.datetime(2024, 9, 5), 1)], "telemetry_timestamp timestamp_ntz, equipment_breach int"
    )
    kpi = gold.executive_kpi(sales, gold.food_waste(*tables), readings)
    rows = {r.kpi_month: r for r in kpi.collect()}
    assert set(rows) == {D(2024, 1, 1), D(2024, 2, 1), None}
    assert rows[D(2024, 1, 1)].total_temp_violations == 1
    assert rows[D(2024, 2, 1)].total_potential_waste_value == 0
    assert [r.ds for r in gold.training_series(gold.daily_demand(sales)).collect()] == [D(2024, 1, 1), D(2024, 2, 1)]


def test_dashboard_ranges(tables):
    waste = gold.food_waste(*tables)
    empty = q.kpi_waste(waste, "2030-01-01", "2030-12-31").first()
    assert (empty.food_waste_rate_pct, empty.total_loss_value) == (None, None)
    assert q.waste_trend(waste, "month", "2024-02-01").count() == 1
    top = q.top_locations(waste, tables[3], n=2).collect()
    assert [(r.store_id, r.location) for r in top] == [("CA_1", "CA"), ("zz", "Unknown")]
    assert top[1].store_name == "Store zz"


def test_product_and_store_labels(spark):
    retail = spark.createDataFrame(
        [
            ("p1", 5.0, "Cat_3", "37", "Pune", "India"),
            ("p1", 5.0, None, "99", None, None),
            ("p1", 4.0, "Cat_9", "CA_CA_1", "Fresno", "Peru"),
            ("p2", None, None, "60", "Agra", "Peru"),
            (None, 1.0, "x", None, "y", None),
        ],
        "product_id string, unit_price double, category_name string, store_id string, store_city string, supplier_country string",
    )
    m5 = spark.createDataFrame([("99", "TX"), ("99", "WI"), (None, "CA")], "store_id string, state_id string")
    products = {r.product_id: (r.category_name, r.default_price) for r in silver.dim_product(retail).collect()}
    assert products == {"p1": ("Meat & Seafood", 5.0), "p2": ("Uncategorized", None)}
    stores = {r.store_id: (r.store_name, r.city, r.state) for r in silver.dim_store(retail, m5).collect()}
    assert stores == {
        "37": ("Mumbai Central", "Pune", None),
        "99": ("Store 99", None, "WI"),
        "CA_CA_1": ("California_California_1", "Fresno", None),
        "60": ("Agra Store", "Agra", None),
    }
    assert silver.dim_supplier(retail).count() == 2


def test_facts_cast_and_filter(spark):
    m5 = spark.createDataFrame(
        [("a", "p", "s", D(2020, 2, 29), 2.5, 1.0), (None, "p", "s", D(2020, 1, 1), 1.0, 1.0)],
        "id string, item_id string, store_id string, date_std date, sales_qty double, sell_price double",
    )
    rows = silver.fact_inventory(m5).collect()
    assert [(r.stock_quantity, r.date_id) for r in rows] == [(3, D(2029, 2, 28))]
    iot = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), "d", t, 1.0, 0.0, 0.0, 0, 1) for t in (-100.0, 100.0, 100.1, None)],
        "timestamp timestamp_ntz, device_mac string, temp_celsius double, humidity_pct double, co_level double, "
        "smoke_level double, is_light int, is_motion int",
    )
    assert silver.fact_cold_chain(iot).count() == 2


def test_numbers(spark):
    row = spark.range(1).select(
        rounded(F.lit(2.675), 2).alias("a"),
        rounded(F.lit(-0.001), 2).alias("b"),
        to_int(F.lit(2.5)).alias("c"),
        log_natural(F.lit(0.0)).alias("d"),
    ).first()
    assert (row.a, str(row.b), row.c, row.d) == (2.68, "0.0", 3, None)


def test_filters_and_columns_reach_the_scan(spark):
    from larder.catalog.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    plan = t.readings.select("date_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan
    assert "GreaterThanOrEqual(value,-100.0)" in plan


@pytest.fixture(scope="module")
def mart(spark):
    """Waste of three stores over twenty days, one day without a date, one product without a name."""
    import random

    r = random.Random(4)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(20)] + [None]
    rows = [(d, s, p, r.random() * 10 ** r.randint(0, 9), r.randint(0, 9), r.randint(0, 20)) for d in days for s in "abc" for p in ("FOODS_1", "FOODS_2", "x", "y")]
    waste = spark.createDataFrame(rows, "date_id date, store_id string, product_id string, potential_waste_value double, unsold_qty long, total_stock long")
    products = spark.createDataFrame([("x", "Toys"), ("FOODS_1", "Else")], "product_id string, category_name string")
    stores = spark.createDataFrame([("a", "A", "Town", None), ("b", None, None, "State")], "store_id string, store_name string, city string, state string")
    return waste.withColumn("category_name", F.lit("unused")), products, stores


def test_states_give_the_rows_of_the_mart(mart):
    waste, products, stores = mart
    kept = states.waste_states(waste, products)
    assert kept.count() < waste.count()
    span = ("2024-01-03", "2024-01-17")
    for query in (
        lambda w, p: q.kpi_waste(w, *span),
        lambda w, p: q.waste_trend(w, "month"),
        lambda w, p: q.waste_trend(w, "day", *span),
        lambda w, p: q.waste_by_category(w, p, *span),
        lambda w, p: q.top_locations(w, stores, 5, *span),
    ):
        assert query(kept, None).collect() == query(waste, products).collect()


def test_compliance_states(spark):
    rows = [(dt.date(2024, 1, 1 + k % 5), f"d{k % 3}", 100.0 / (k + 1) if k % 7 else None, k) for k in range(15)]
    compliance = spark.createDataFrame(rows, "date_id date, device_id string, compliance_rate_pct double, equipment_breach_count long")
    kept = states.compliance_states(compliance)
    for query in (q.kpi_cold_chain, q.breach_timeline, q.compliance_by_month):
        assert query(kept).collect() == query(compliance).collect()


def test_changed_days_give_what_a_full_rebuild_gives(spark, mart):
    waste, products, _ = mart
    old = states.waste_states(waste, products)
    # Two days change, one goes, one comes, and so do rows without a day.
    changed = waste.withColumn("unsold_qty", F.when(F.day("date_id").isin(2, 9) | F.col("date_id").isNull(), F.col("unsold_qty") + 1).otherwise(F.col("unsold_qty")))
    changed = changed.filter(~F.coalesce(F.day("date_id") == 5, F.lit(False)))
    changed = changed.unionByName(waste.filter("day(date_id) = 1").withColumn("date_id", F.lit("2024-03-01").cast("date")))
    days = spark.createDataFrame([(dt.date(2024, 1, 2),), (dt.date(2024, 1, 9),), (dt.date(2024, 1, 5),), (dt.date(2024, 3, 1),), (None,)], "date_id date")
    partial = states.changed_days(old, changed, days, lambda m: states.waste_states(m, products))
    want = states.waste_states(changed, products)
    assert sorted(map(str, partial.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_fixed_values():
    """Values that results must agree on, as literals."""
    assert gold.CURRENCY_FACTOR == 15000 and gold.FLAT_STOCK == 1000 and gold.NORMAL_Z80 == 1.28 and gold.DEFAULT_PRICE == 10.0
    assert gold.FAMILY_PRICES == {"FOODS": 15.0, "HOUSEHOLD": 25.0, "HOBBIES": 40.0}
    assert gold.FAMILY_CATEGORIES == {"FOODS": "Food & Beverage", "HOUSEHOLD": "Household & Cleaning", "HOBBIES": "Hobbies & Toys"}
    assert states.FAMILY_NAMES == {"FOODS": "Foods", "HOUSEHOLD": "Household", "HOBBIES": "Hobbies"}
    assert (gold.HIGH_WASTE_PCT, gold.MODERATE_WASTE_PCT) == (20, 5)


def exchanges(df, *parts: str) -> list[str]:
    """The shuffles of a plan, with the size-checked broadcast off, whose line holds all ``parts``."""
    conf = df.sparkSession.conf
    old = {k: conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        conf.set("spark.sql.adaptive.enabled", "false")
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            conf.set(k, v)
    return [line for line in plan.splitlines() if " Exchange hashpartitioning" in line and all(p in line for p in parts)]


def test_keyed_waste_groups_stock_and_sales_together(spark):
    day = D(2024, 1, 1)
    sales = spark.createDataFrame(
        [(day, "a", "s", 4), (day, "a", "s", 5), (None, "a", "s", 7), (day, None, "s", 7), (day, "a", None, 7), (day, "z", "s", 7), (day, "c", "s", None)],
        "order_date_id date, product_id string, store_id string, quantity int",
    )
    stock = spark.createDataFrame(
        [(day, "a", "s", 20, 1.5), (None, "a", "s", 20, 1.5), (day, None, "s", 20, None), (day, "a", None, 20, 1.5), (day, "c", "s", None, 2.0)],
        "date_id date, product_id string, store_id string, stock_quantity int, current_price double",
    )
    products = spark.createDataFrame([("a", "A")], "product_id string, category_name string")
    waste = gold.food_waste(sales, products, stock, method="keyed")
    rows = {(r.date_id, r.product_id, r.store_id): (r.total_stock, r.total_sold, r.category_name) for r in waste.collect()}
    # Keys with a missing part never meet, sales without stock have no row.
    assert rows == {
        (day, "a", "s"): (20, 9, "A"), (None, "a", "s"): (20, 0, "A"), (day, None, "s"): (20, 0, None),
        (day, "a", None): (20, 0, "A"), (day, "c", "s"): (None, 0, None),
    }
    assert len(exchanges(waste, "date_id", "product_id", "store_id")) == 1


def test_baseline_rows_are_dealt_by_product_once(spark, tables):
    sales, products, _, _ = tables
    dates = spark.sql("SELECT DATE '2024-01-01' + x AS date_id, 2024L AS year, 1L AS month, 'Monday' AS day_name FROM (SELECT explode(sequence(0, 60)) AS x)")
    demand = gold.demand_baseline(sales, dates, products)
    assert not exchanges(demand, "hashpartitioning(product_id#", ", store_id#") or all("date_id" in x for x in exchanges(demand, ", store_id#"))
    # One for the daily rows, one for the products.
    assert len(exchanges(demand, "hashpartitioning(product_id#")) - len(exchanges(demand, "hashpartitioning(product_id#", "store_id#")) == 2
    assert sorted(r.daily_sales_qty for r in demand.collect()) == [3, 7, 2000]


def test_spread_waste_shuffles_the_inventory_once(spark, tables):
    waste = gold.food_waste(*tables)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = waste.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    keyed = [x for x in plan.splitlines() if "hashpartitioning(date_id#" in x and "product_id#" in x and "store_id#" in x]
    assert ["ReusedExchange" in x for x in keyed if "Exchange" in x] == [False, True]
