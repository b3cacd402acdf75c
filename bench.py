"""Times table builds and headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose data and threads.
``build_*`` entries rebuild one stored table from its stored inputs, as the weekly job does;
``build_silver_layer`` is all eight silver tables. The other entries run a query straight
on the Parquet test tables, in full, into the no-op sink.
"""

from __future__ import annotations

import json
import os
import time

from larder.catalog import entries
from larder.catalog.tables import Tables
from larder.plans.refresh import models, refresh
from larder.session import local_session, staged_files_removed, work_path
from larder.sources.tables import Lake

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "v2_dim_product",
    "v3_dim_store",
    "v5_fact_sales",
    "g1_food_waste_spread",
    "g6_executive_kpi",
    "g8_supplier_performance",
    "g9_demand_baseline",
    "q1_kpi_waste",
    "q6_waste_by_category",
    "q8_top_locations",
    "m1_anomaly_features",
    "m4_mean_mape",
    "d3_date_dimension",
    "d5_fiscal_periods",
    "e21_values_increasing",
    "e37_match_regex",
    "e52_quantile_between",
    "e61_compound_unique",
    "e62_unique_within_record",
    "e64_within_n_moving_stdevs",
    "e68_project_suite",
    "x1_running_sum",
    "x2_median",
]


def build_times(spark) -> dict[str, float]:
    """Seconds per table rebuild."""
    tables, lake = Tables(spark, SF_DIR), Lake(spark, work_path(spark, "bench"))
    for name in ("retail_data", "m5_forcasting", "SupplyChain", "iot_telemetry"):
        # As many files as threads: bronze tables arrive in several files.
        lake.write(tables.bronze(name).repartition(8), "bronze", name)
    seconds: dict[str, float] = {}
    start = time.perf_counter()
    refresh(lake, ["silver"])
    seconds["build_silver_layer"] = round(time.perf_counter() - start, 3)
    for name, model in models(lake).items():
        if model.layer == "gold":
            start = time.perf_counter()
            refresh(lake, select=[name])
            seconds[f"build_{name.split('.')[1]}"] = round(time.perf_counter() - start, 3)
    return seconds


def main() -> None:
    spark = local_session("bench", CPUS, partitions=int(CPUS) if CPUS.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    known = entries()
    seconds = build_times(spark)
    for name in HEADLINE:
        with staged_files_removed(spark):
            start = time.perf_counter()
            known[name].run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
