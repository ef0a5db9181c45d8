"""The daily run: the warehouse brought up to date from the orders that changed.

``start`` builds everything once, with the fact in ranges of order ids and the mart's states
beside it. ``refresh`` then reads the landed tables for the changed orders alone, rewrites
the ranges of the fact they lie in, makes the states of these ranges anew (of the mart and
of the fact's checks) and the mart from all states. The result equals a full rebuild.
"""

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.audit import stamped
from salesmart.operators import check_states
from salesmart.operators.quality import DECLARED
from salesmart.plans import finance, rollup
from salesmart.plans.build import LAYERS, RunOptions, Warehouse, write_all
from salesmart.plans.facts import rebuilt_orders
from salesmart.sources.tables import full_refresh, layer_name
from salesmart.sources.versions import (
    RANGE, range_settings, refresh_versioned, replace_keys, rows_of_ranges, touched_ranges,
)

ORDERS_PER_RANGE = 10_000_000


def changed_since(orders: DataFrame, since: dt.datetime) -> DataFrame:
    """Ids of orders stamped after ``since``. Deleted orders have to be listed by other means."""
    return orders.where(F.col("updated_at") > F.lit(since).cast("timestamp_ntz")).select("order_id").distinct()


def orders_of_changed_dimensions(orders: DataFrame, before: Mapping, after: Mapping) -> DataFrame:
    """Ids of orders whose fact rows differ because a customer or a product does.

    The fact takes from them whether they are known, and a product's cost: customers that
    came or went, products that came, went or have another cost.
    """
    found = []
    for name, columns in (("dim_customers", ["customer_id"]), ("dim_products", ["product_id", "cost_price"])):
        old, new = (side[name].select(*columns) for side in (before, after))
        differ = old.exceptAll(new).unionByName(new.exceptAll(old)).select(columns[0]).distinct()
        found.append(orders.join(differ, columns[0], "left_semi").select("order_id"))
    return found[0].unionByName(found[1]).distinct()


class Places:
    """Names of the tables of a run."""

    def __init__(self, prefix: str | None):
        self.core = {n: f"{layer_name(layer, prefix)}.{n}" for n, layer in LAYERS.items()}
        self.fact, self.mart = self.core["fact_orders"], self.core["revenue_analysis"]
        finance_, core = layer_name("finance", prefix), layer_name("core", prefix)
        self.sums, self.members = f"{finance_}.state_sums", f"{finance_}.state_members"
        self.failures, self.references = f"{core}.state_failures", f"{core}.state_references"
        self.pending = f"{core}.changed_orders"


FACT_CHECKS = [c for c in DECLARED if c.table == "fact_orders"]


def _states(
    fact: DataFrame, tables: Mapping[str, DataFrame], width: int, places: Places
) -> list[tuple[str, str, DataFrame]]:
    """(table, range column, states) of the given fact rows, for the mart and for the checks."""
    place = F.expr(f"CAST(order_id AS BIGINT) div {int(width)}")
    ranged = fact.withColumn(check_states.STATE_RANGE, place)
    # An order key is made of the order's id, so its rows share a range.
    failures = check_states.failure_states(ranged, FACT_CHECKS, ["order_key"])
    members = rollup.member_states(fact, tables["dim_customers"], tables["dim_dates"], width)
    return [
        (places.sums, rollup.FACT_RANGE, rollup.sum_states(fact, tables["dim_dates"], width)),
        (places.members, rollup.FACT_RANGE, members),
        (places.failures, check_states.STATE_RANGE, failures),
        (places.references, check_states.STATE_RANGE, check_states.reference_states(ranged, FACT_CHECKS)),
    ]


def fact_checks(spark: SparkSession, prefix: str | None = None) -> DataFrame:
    """The declared checks of the fact, from the states of its ranges."""
    places = Places(prefix)
    parents = {c.parent: spark.table(places.core[c.parent]) for c in FACT_CHECKS if c.parent}
    states = spark.table(places.failures), spark.table(places.references)
    return check_states.suite_from_states(*states, parents, FACT_CHECKS)


def _write_mart(places: Places, dim_dates: DataFrame, options: RunOptions) -> DataFrame:
    spark = dim_dates.sparkSession
    totals = rollup.merged_totals(spark.table(places.sums), spark.table(places.members), dim_dates)
    report = finance.period_report(totals, safe=options.safe)
    return full_refresh(stamped(report, options.run_ts), places.mart)


def start(
    sources: Mapping[str, DataFrame],
    options: RunOptions = RunOptions(),
    prefix: str | None = None,
    width: int = ORDERS_PER_RANGE,
) -> dict[str, DataFrame]:
    """Everything from the sources; the fact in ranges, and the states of the mart."""
    tables = write_all(sources, options, prefix, fact_width=width)
    places = Places(prefix)
    for name, key, rows in _states(tables["fact_orders"], tables, width, places):
        refresh_versioned(rows, name, key, 1)
    full_refresh(tables["fact_orders"].select("order_id").limit(0), places.pending)
    return tables


def refresh(
    sources: Mapping[str, DataFrame],
    changed: DataFrame,
    options: RunOptions = RunOptions(),
    prefix: str | None = None,
) -> dict[str, DataFrame]:
    """Bring the tables of ``start`` up to date after the orders in ``changed`` (ids) changed.

    ``sources`` hold the present rows: orders that changed, came or went, customers and
    products in their new state. The list of changed orders is written down before anything
    else changes, and emptied at the end: a run that fails is made good by the next.
    """
    places = Places(prefix)
    orders = sources["orders"]
    spark = orders.sparkSession
    warehouse = Warehouse(sources, options)
    dimensions = ("dim_customers", "dim_products", "dim_dates")
    before = {n: spark.table(places.core[n]) for n in dimensions}
    after = {n: getattr(warehouse, n) for n in dimensions}
    pending = spark.table(places.pending)
    due = (
        pending.unionByName(changed.select(F.col("order_id").cast(pending.schema["order_id"].dataType)))
        .unionByName(orders_of_changed_dimensions(orders, before, after))
        .distinct()
    )
    due = full_refresh(due, places.pending)
    tables = {n: full_refresh(after[n], places.core[n]) for n in dimensions}

    _, width = range_settings(spark, places.fact)
    made = rebuilt_orders(orders, due, *tables.values(), options.run_ts)
    tables["fact_orders"] = replace_keys(made, places.fact, due)
    touched = touched_ranges(spark, places.fact, due)
    fact = rows_of_ranges(spark, places.fact, touched)
    for name, key, rows in _states(fact, tables, width, places):
        replace_keys(rows, name, touched.select(F.col(RANGE).alias(key)))
    tables["revenue_analysis"] = _write_mart(places, tables["dim_dates"], options)
    full_refresh(due.limit(0), places.pending)
    return tables
