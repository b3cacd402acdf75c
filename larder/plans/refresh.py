"""The rebuild job: silver, then gold, each table from the ones it needs."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators import anomaly, forecast, gold, silver
from larder.session import staged_files_removed
from larder.sources.tables import Lake, in_ranges


class RefreshError(RuntimeError):
    """A table could not be rebuilt; later ones were not started."""


@dataclass(frozen=True)
class Model:
    """A table, the tables it reads (``layer.name``), how it is built, the column its files are laid out by,
    columns looked up by value that get Bloom filters, and for a table that renames and casts the rows of its one input, instead of
    the column, the expression over that input by which they are laid out before: numbers move in fewer bytes than their texts."""

    layer: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    cluster_by: str | None = None
    bloom: tuple[str, ...] = ()
    ordered: str | None = None


def _waste(sales, products, inventory, stores):
    return gold.food_waste(sales, products, inventory, stores)


ORDER_DAY = "CAST(order_date AS DATE)"


def models(lake: Lake, shift_years: int = 9) -> dict[str, Model]:
    """All tables by ``layer.name``. Stock is moved ``shift_years`` forward, to where the sales are; 0 if it is there already."""
    s, g = "silver", "gold"

    def inventory(m5: DataFrame) -> DataFrame:
        return silver.fact_inventory(m5, shift_years=shift_years)

    return {
        "silver.dim_date": Model(s, (), lambda: silver.dim_date(lake.spark)),
        "silver.dim_product": Model(s, ("bronze.retail_data",), silver.dim_product),
        "silver.dim_store": Model(s, ("bronze.retail_data", "bronze.m5_forcasting"), silver.dim_store),
        "silver.dim_supplier": Model(s, ("bronze.retail_data",), silver.dim_supplier),
        "silver.fact_sales": Model(s, ("bronze.retail_data",), silver.fact_sales, None, ("order_item_id",), ORDER_DAY),
        "silver.fact_inventory": Model(s, ("bronze.m5_forcasting",), inventory, "date_id"),
        "silver.fact_purchase_order": Model(s, ("bronze.SupplyChain",), silver.fact_purchase_order, ordered=ORDER_DAY),
        "silver.fact_cold_chain": Model(s, ("bronze.iot_telemetry",), silver.fact_cold_chain, "date_id"),
        "gold.food_waste_summary": Model(
            g, ("silver.fact_sales", "silver.dim_product", "silver.fact_inventory", "silver.dim_store"), _waste
        ),
        "gold.anomaly_check": Model(g, ("silver.fact_cold_chain",), anomaly.anomaly_check),
        "gold.cold_chain_compliance": Model(g, ("gold.anomaly_check",), gold.cold_chain_compliance),
        "gold.executive_kpi": Model(
            g, ("silver.fact_sales", "gold.food_waste_summary", "gold.anomaly_check"), gold.executive_kpi
        ),
        "gold.supplier_performance": Model(g, ("silver.fact_purchase_order",), gold.supplier_performance),
        "gold.daily_demand": Model(g, ("silver.fact_sales",), gold.daily_demand),
        "gold.demand_forecast": Model(g, ("silver.fact_sales",), forecast.demand_forecast),
    }


# Rebuilt after new telemetry arrives
COLD_CHAIN = ("silver.fact_cold_chain", "gold.anomaly_check", "gold.cold_chain_compliance", "gold.executive_kpi")


def refresh(
    lake: Lake,
    layers: Iterable[str] = ("silver", "gold"),
    select: Iterable[str] | None = None,
    parallel: int = 4,
    shift_years: int = 9,
) -> list[str]:
    """Rebuild the chosen tables in dependency order and return their names; ``shift_years`` as in :func:`models`.

    Each table is written before the next one reads it, so every step starts from stored
    data; tables that do not depend on each other are built ``parallel`` at a time. After a failure
    nothing new is started, and the job ends with an error.
    """
    known = models(lake, shift_years)
    layers = set(layers)
    wanted = set(select) if select is not None else {n for n, m in known.items() if m.layer in layers}
    order = TopologicalSorter({n: [i for i in m.inputs if i in known] for n, m in known.items()}).static_order()
    done: list[str] = []

    def build(name: str) -> str:
        model = known[name]
        layer, table = name.split(".", 1)
        inputs = [lake.read(*i.split(".", 1)) for i in model.inputs]
        if model.ordered:
            inputs[0] = in_ranges(inputs[0], F.expr(model.ordered))
        lake.write(model.build(*inputs), layer, table, model.cluster_by, model.bloom)
        return name

    chosen = {n: {i for i in known[n].inputs if i in wanted} for n in order if n in wanted}
    sorter = TopologicalSorter(chosen)
    sorter.prepare()
    with staged_files_removed(lake.spark), ThreadPoolExecutor(parallel) as pool:
        running: dict = {}
        while sorter.is_active():
            for name in sorter.get_ready():
                running[pool.submit(inheritable_thread_target(lake.spark)(build), name)] = name
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                if (problem := future.exception()) is not None:
                    wait(running)
                    raise RefreshError(f"{name} could not be rebuilt after {done or 'nothing'}") from problem
                done.append(name)
                sorter.done(name)
    return done
