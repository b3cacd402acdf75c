"""Dashboard queries. The ranges are the first and last full years of the test data."""

from __future__ import annotations

from larder.catalog.entry import Entry
from larder.catalog.sqltext import OF_PERIODS, OF_TOTALS, davg, family, rnd, rsum, with_tables
from larder.catalog.tables import Warehouse, settled
from larder.operators import dashboard as q
from larder.operators import gold
from larder.operators.states import FAMILY_NAMES
from larder.sources.tables import row_counts

_RATE = rnd("CAST(SUM(unsold_qty) AS DOUBLE) * 100.0 / NULLIF(SUM(total_stock), 0)", 2)
#: Rounded as the operator does, then to what is compared.
_LOSS, _PERIOD_LOSS = (rnd(rsum("potential_waste_value", 2), places) for places in (OF_TOTALS, OF_PERIODS))
_MEAN_RATE = rnd(davg("compliance_rate_pct"), 2)
_BREACHES = "CAST(SUM(equipment_breach_count) AS BIGINT)"
_UNSOLD = "CAST(SUM(unsold_qty) AS BIGINT)"
_START, _END = "1995-01-01", "2002-12-31"
_RANGE = f"date_id BETWEEN DATE '{_START}' AND DATE '{_END}'"


def _forecast(spark, sf):
    """The statistical baseline in the shape of a forecast table."""
    t = Warehouse(spark, sf)
    demand = gold.daily_demand(t.sales)
    forecast = demand.selectExpr(
        "date_id AS ds",
        "daily_sales_qty * 1.1D AS forecast_qty",
        "daily_sales_qty * 0.9D AS lower_bound",
        "daily_sales_qty * 1.3D AS upper_bound",
    )
    return q.forecast_window(forecast, _START, _END)


def _ranges(spark, sf):
    t = Warehouse(spark, sf)
    demand = gold.daily_demand(t.sales)
    return {
        "food_waste": (t.waste, "date_id"),
        "executive_kpi": (t.kpi, "kpi_month"),
        "daily_demand": (demand, "date_id"),
    }


def _counts(spark, sf):
    t = Warehouse(spark, sf)
    names = ["fact_sales", "fact_inventory", "fact_cold_chain", "dim_product", "dim_store"]
    frames = [t.sales, t.inventory, t.readings, t.products, t.stores]
    return row_counts(dict(zip(names, frames)))


_PROFILE = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, MIN({c}) AS min_date, MAX({c}) AS max_date, COUNT(*) AS row_count FROM {source}"
    for name, c, source in (
        ("food_waste", "date_id", "food_waste"),
        ("executive_kpi", "kpi_month", "kpi"),
        ("daily_demand", "date_id", "(SELECT DISTINCT order_date_id AS date_id FROM fact_sales)"),
    )
)

ENTRIES = [
    Entry(
        "q1_kpi_waste",
        lambda s, d: settled(q.kpi_waste(Warehouse(s, d).waste_states, _START, _END), {"total_loss_value": OF_TOTALS}),
        with_tables(
            f"SELECT {_RATE} AS food_waste_rate_pct, {_LOSS} AS total_loss_value FROM food_waste WHERE {_RANGE}",
            "food_waste",
        ),
    ),
    Entry(
        "q2_kpi_cold_chain",
        lambda s, d: q.kpi_cold_chain(Warehouse(s, d).compliance_states, "2024-01-01", "2024-12-31"),
        with_tables(
            f"SELECT {_MEAN_RATE} AS cold_chain_compliance_rate_pct, {_BREACHES} AS total_breaches FROM compliance "
            "WHERE date_id BETWEEN DATE '2024-01-01' AND DATE '2024-12-31'",
            "compliance",
        ),
    ),
    Entry(
        "q3_kpi_revenue",
        lambda s, d: q.kpi_revenue(Warehouse(s, d).kpi, _START, _END),
        with_tables(
            f"SELECT {rsum('total_revenue', 2)} AS total_revenue FROM kpi "
            f"WHERE kpi_month BETWEEN DATE '{_START}' AND DATE '{_END}'",
            "kpi",
        ),
    ),
    Entry(
        "q4_waste_trend_month",
        lambda s, d: settled(q.waste_trend(Warehouse(s, d).waste_states, "month", _START, _END), {"total_loss_value": OF_PERIODS}),
        with_tables(
            f"SELECT CAST(DATE_TRUNC('month', date_id) AS DATE) AS month, {_RATE} AS food_waste_rate_pct, "
            f"{_PERIOD_LOSS} AS total_loss_value FROM food_waste WHERE {_RANGE} GROUP BY 1",
            "food_waste",
        ),
    ),
    Entry(
        "q5_waste_trend_day",
        lambda s, d: settled(q.waste_trend(Warehouse(s, d).waste_states, "day", _START, _END), {"total_loss_value": OF_PERIODS}),
        with_tables(
            f"SELECT date_id, {_RATE} AS food_waste_rate_pct, {_PERIOD_LOSS} AS total_loss_value "
            f"FROM food_waste WHERE {_RANGE} GROUP BY 1",
            "food_waste",
        ),
    ),
    Entry(
        "q6_waste_by_category",
        lambda s, d: settled(q.waste_by_category(Warehouse(s, d).waste_states, start=_START, end=_END), {"total_loss_value": OF_TOTALS}),
        with_tables(
            f"""SELECT category, {rnd(rsum('lost', 2), OF_TOTALS)} AS total_loss_value, {_RATE} AS waste_rate_pct, {_UNSOLD} AS total_unsold_qty
            FROM (SELECT product_id, fsum(potential_waste_value) AS lost, SUM(unsold_qty) AS unsold_qty, SUM(total_stock) AS total_stock
                  FROM food_waste WHERE {_RANGE} GROUP BY 1)
            LEFT JOIN (SELECT product_id, category_name AS named FROM dim_product) USING (product_id),
              LATERAL (SELECT {family('product_id', FAMILY_NAMES, "COALESCE(named, 'Other')")} AS category)
            GROUP BY category""",
            "food_waste",
            "dim_product",
        ),
    ),
    Entry(
        "q7_breach_timeline",
        lambda s, d: q.breach_timeline(Warehouse(s, d).compliance_states),
        with_tables(
            f"SELECT date_id, {_BREACHES} AS total_breaches, {_MEAN_RATE} AS avg_compliance_rate_pct, "
            "COUNT(DISTINCT device_id) AS devices_monitored FROM compliance GROUP BY 1",
            "compliance",
        ),
    ),
    Entry(
        "q8_top_locations",
        lambda s, d: settled(q.top_locations(Warehouse(s, d).waste_states, Warehouse(s, d).stores, 5, _START, _END), {"total_loss_value": OF_TOTALS}),
        with_tables(
            f"""SELECT store_id, COALESCE(store_name, 'Store ' || store_id) AS store_name, COALESCE(city, state, 'Unknown') AS location,
              total_loss_value, waste_rate_pct, total_unsold_qty
            FROM (SELECT store_id, {_LOSS} AS total_loss_value, {_RATE} AS waste_rate_pct, {_UNSOLD} AS total_unsold_qty
                  FROM food_waste WHERE {_RANGE} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
            LEFT JOIN dim_store USING (store_id)""",
            "food_waste",
            "dim_store",
        ),
    ),
    Entry(
        "q9_forecast_window",
        _forecast,
        with_tables(
            f"""SELECT ds AS date_id, {rnd('q * 1.1::DOUBLE', 0)} AS forecast_unit,
              {rnd('q * 0.9::DOUBLE', 0)} AS lower_bound, {rnd('q * 1.3::DOUBLE', 0)} AS upper_bound
            FROM (SELECT order_date_id AS ds, CAST(SUM(quantity) AS DOUBLE) AS q FROM fact_sales GROUP BY 1)
            WHERE ds BETWEEN DATE '{_START}' AND DATE '{_END}'""",
            "fact_sales",
        ),
    ),
    Entry(
        "q10_compliance_by_month",
        lambda s, d: q.compliance_by_month(Warehouse(s, d).compliance_states, "2024-01-01"),
        with_tables(
            f"SELECT CAST(DATE_TRUNC('month', date_id) AS DATE) AS month, {_MEAN_RATE} AS avg_compliance, "
            f"{_BREACHES} AS total_breaches FROM compliance WHERE date_id >= DATE '2024-01-01' GROUP BY 1",
            "compliance",
        ),
    ),
    Entry(
        "q11_date_overlap",
        lambda s, d: q.date_overlap(_ranges(s, d)),
        with_tables(
            f"SELECT MAX(min_date) AS overlap_start, MIN(max_date) AS overlap_end FROM ({_PROFILE})",
            "food_waste",
            "kpi",
        ),
    ),
    Entry(
        "q11_date_profile",
        lambda s, d: q.date_profile(_ranges(s, d)),
        with_tables(_PROFILE, "food_waste", "kpi"),
    ),
    Entry(
        "q12_table_row_counts",
        _counts,
        with_tables(
            " UNION ALL ".join(
                f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}"
                for n in ("fact_sales", "fact_inventory", "fact_cold_chain", "dim_product", "dim_store")
            ),
            "fact_sales",
            "fact_inventory",
            "fact_cold_chain",
            "dim_product",
            "dim_store",
        ),
    ),
]
