"""What the catalog's warehouse stores, and which tables its sales lines need."""

from __future__ import annotations

import os

import pytest
from compare import TABLES, compare, duck

from larder.catalog import entries, tables
from larder.catalog.tables import Tables, Warehouse
from larder.operators import gold, states

SF = "/root/testdata/sf0.001"


def altered(tmp_path, **replaced: str) -> str:
    """The smallest data with some tables replaced by a query."""
    for t in TABLES:
        if t not in replaced:
            os.symlink(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    con = duck(SF)
    for t, query in replaced.items():
        con.execute(f"COPY ({query}) TO '{tmp_path}/{t}.parquet'")
    return str(tmp_path)


def files(frame) -> set[str]:
    return {f.rsplit("/", 1)[1] for f in frame.inputFiles()}


def test_daily_demand_reads_lines_and_orders_only(spark):
    demand = gold.daily_demand(Warehouse(spark, SF).sales)
    assert files(demand) == {"lineitem.parquet", "orders.parquet", "customer.parquet", "nation.parquet"}


def test_renamed_tables_are_not_stored_again(spark, tmp_path):
    sf = altered(tmp_path)
    entries()["e68_project_suite"].run(spark, sf).collect()
    entries()["q8_top_locations"].run(spark, sf).collect()
    lake = tables._lakes[spark.sparkContext.applicationId, sf]
    kept = {f"{layer}.{name}" for layer in ("bronze", "silver", "gold") if os.path.isdir(lake.path(layer, "")) for name in os.listdir(lake.path(layer, ""))}
    assert kept == {"silver.products", "silver.stores", "gold.waste", "gold.waste_states"}


@pytest.mark.parametrize(
    "replaced",
    [
        {"part": "SELECT * FROM part WHERE p_partkey % 3 <> 0"},
        {"supplier": "SELECT * FROM supplier WHERE s_suppkey <> 2"},
        {"supplier": "SELECT * REPLACE (CASE WHEN s_suppkey = 2 THEN 99 ELSE s_nationkey END AS s_nationkey) FROM supplier"},
        {"part": "SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_partkey % 5 = 0"},
        {"lineitem": "SELECT * REPLACE (CASE WHEN l_linenumber = 2 THEN NULL ELSE l_suppkey END AS l_suppkey) FROM lineitem"},
    ],
    ids=["parts missing", "supplier missing", "nation missing", "parts twice", "null supplier"],
)
def test_lines_without_exactly_one_part_and_supplier(spark, tmp_path, replaced):
    sf = altered(tmp_path, **replaced)
    con = duck(sf)
    assert Warehouse(spark, sf).sales.count() == Tables(spark, sf).sales.count() != Tables(spark, SF).sales.count()
    for name in ("g10_daily_demand", "g2b_food_waste_flat_stock"):
        assert compare(spark, con, name, entries()[name], sf) is None


def test_products_of_whole_lines(spark):
    made, wanted = Warehouse(spark, SF).products, Tables(spark, SF).products
    assert made.columns == wanted.columns and made.exceptAll(wanted).isEmpty() and wanted.exceptAll(made).isEmpty()


@pytest.mark.parametrize(
    "replaced",
    [
        {"orders": "SELECT * FROM orders WHERE o_orderkey % 3 <> 0"},
        {"orders": "SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 5 = 0"},
        {"customer": "SELECT * FROM customer WHERE c_custkey % 4 <> 0"},
        {"customer": "SELECT * REPLACE (CASE WHEN c_custkey % 4 = 0 THEN 99 ELSE c_nationkey END AS c_nationkey) FROM customer"},
        {"lineitem": "SELECT * REPLACE (CASE WHEN l_linenumber = 2 THEN NULL ELSE l_orderkey END AS l_orderkey) FROM lineitem"},
    ],
    ids=["orders missing", "orders twice", "customer missing", "nation missing", "null order"],
)
def test_lines_without_exactly_one_order(spark, tmp_path, replaced):
    sf = altered(tmp_path, **replaced)
    con = duck(sf)
    made, wanted = Warehouse(spark, sf), Tables(spark, sf)
    for name in ("products", "stores"):
        rows = [getattr(t, name).collect() for t in (made, wanted)]
        assert sorted(map(str, rows[0])) == sorted(map(str, rows[1]))
    for name in ("g2a_food_waste_keyed", "g9_demand_baseline", "q4_waste_trend_month", "e68_project_suite"):
        assert compare(spark, con, name, entries()[name], sf) is None


def built_from(spark, sf, monkeypatch, *names) -> dict:
    """The files that stored tables are built from."""
    seen = {}
    write = tables.Lake.write

    def noted(lake, df, layer, name, *args):
        seen[name] = files(df)
        return write(lake, df, layer, name, *args)

    monkeypatch.setattr(tables.Lake, "write", noted)
    for name in names:
        getattr(Warehouse(spark, sf), name)
    return seen


def test_products_need_no_orders(spark, tmp_path, monkeypatch):
    sf = altered(tmp_path)
    assert built_from(spark, sf, monkeypatch, "products")["products"] == {"lineitem.parquet", "part.parquet"}


def test_states_need_no_products(spark, tmp_path, monkeypatch):
    sf = altered(tmp_path)
    made = built_from(spark, sf, monkeypatch, "waste_states")["waste_states"]
    mart = Warehouse(spark, sf).waste
    assert made == files(mart)
    kept, wanted = Warehouse(spark, sf).waste_states, states.waste_states(mart, Warehouse(spark, sf).products)
    assert sorted(map(str, kept.collect())) == sorted(map(str, wanted.select(kept.columns).collect()))


def test_checks_of_lines_need_no_orders(spark, tmp_path):
    assert files(Warehouse(spark, altered(tmp_path)).retail_lines_only) == {"lineitem.parquet"}
