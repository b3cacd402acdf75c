"""The warehouse's own data-quality suite."""

from __future__ import annotations

from larder.operators.suite import Check

_ROWS = "expect_table_row_count_to_be_between"
_BETWEEN = "expect_column_values_to_be_between"

# --- fixed values: accepted row counts, ranges and states ------------------------------

BRONZE = [
    Check("instacart_grocery", _ROWS, {"min_value": 1000, "max_value": 5_000_000}),
    Check("instacart_grocery", "not_null", {"column": "order_id"}),
    Check("retail_data", _ROWS, {"min_value": 100, "max_value": 5_000_000}),
    Check("retail_data", "not_null", {"column": "order_item_id"}),
    Check("m5_forcasting", _ROWS, {"min_value": 1000, "max_value": 10_000_000}),
    Check("m5_forcasting", "not_null", {"column": "id"}),
    Check("iot_telemetry", _ROWS, {"min_value": 100, "max_value": 5_000_000}),
    Check("iot_telemetry", "not_null", {"column": "timestamp"}),
    Check("iot_telemetry", "not_null", {"column": "device_mac"}),
    Check("SupplyChain", _ROWS, {"min_value": 100, "max_value": 5_000_000}),
    Check("SupplyChain", "not_null", {"column": "`Order Item Id`"}),
    Check("SupplyChain", "unique", {"column": "`Order Item Id`"}),
    Check("SupplyChain", "not_null", {"column": "order_id"}),
]

STAGING = [
    Check("stg_instacart_grocery", "not_null", {"column": "order_id"}),
    Check("stg_instacart_grocery", "not_null", {"column": "product_id"}),
]

SILVER = [
    Check("silver_fact_cold_chain", _BETWEEN, {"column": "temperature_c", "min_value": -50.0, "max_value": 60.0}),
    Check("silver_fact_cold_chain", _BETWEEN, {"column": "humidity_percentage", "min_value": 0, "max_value": 100}),
]

GOLD = [
    Check("gold_mart_food_waste_summary", _BETWEEN, {"column": "waste_rate_pct", "min_value": 0.0, "max_value": 100.0}),
    Check(
        "gold_mart_food_waste_summary",
        "expect_column_values_to_be_in_set",
        {"column": "waste_rate_status", "value_set": ["Healthy", "Moderate Risk", "High Waste Risk", "No Stock"]},
    ),
]

PROJECT = [*BRONZE, *STAGING, *SILVER, *GOLD]
