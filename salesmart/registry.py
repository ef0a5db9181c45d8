"""Named queries over the Parquet test tables, one or more per operator.

Every query reads the tables of its folder whole. Results are made comparable with those
of another engine: audit stamps are dropped, decimals become doubles, and dates and
timestamps become text.
"""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.operators import landing, quality, verify
from salesmart.operators.calendar import (
    CALENDAR_END, CALENDAR_START, covering_bounds, date_spine, spine_between,
)
from salesmart.operators.reconcile import reconcile
from salesmart.plans import finance, rollup
from salesmart.plans.build import RunOptions, Warehouse
from salesmart.plans.dimensions import dim_dates
from salesmart.plans.facts import merge_fact
from salesmart.schemas import LANDING, WIDTHS, column_defaults
from salesmart.sources.adapt import adapt, read_table
from salesmart.sources.synth import synth_customers, synth_orders, synth_products

# The test clock.
AS_OF = dt.date(2001, 8, 2)
AS_OF_TIME = dt.datetime(2001, 8, 2)
SEED = 42
# A calendar that ends before the orders do.
SHORT_CALENDAR_END = dt.date(2000, 1, 1)
NARROW_WIDTHS = {"product_name": 8, "category": 5, "description": 6}
NEW_CUSTOMER_BASE = 1_000_000_000
ORDER_KEYS = ["order_id", "product_id"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select([plain(f) for f in df.schema if not f.name.startswith("dw_")])


def query(build: Query) -> Query:
    """Register a query under its function's name (less the leading underscore)."""
    name = build.__name__.removeprefix("_")
    QUERIES[name] = lambda spark, folder: portable(build(spark, folder))
    return build


OPTIONS = RunOptions(as_of=AS_OF, run_ts=AS_OF_TIME)


def _warehouse(spark: SparkSession, folder: str) -> Warehouse:
    return Warehouse(adapt(spark, folder), OPTIONS)


def _model(name: str) -> None:
    QUERIES[name] = lambda spark, folder: portable(getattr(_warehouse(spark, folder), name))


for _name in (
    "stg_customers", "stg_products", "stg_orders", "dim_customers", "dim_products",
    "fact_orders", "revenue_analysis",
):
    _model(_name)


# Calendar ------------------------------------------------------------------------------


@query
def _date_spine(spark, folder):
    return spine_between(covering_bounds(read_table(spark, folder, "orders"), "o_orderdate"))


@query
def _dim_dates(spark, folder):
    orders = read_table(spark, folder, "orders")
    bounds = covering_bounds(orders, "o_orderdate", CALENDAR_START, CALENDAR_END)
    return dim_dates(spine_between(bounds), run_ts=AS_OF_TIME)


# Parts of the mart ---------------------------------------------------------------------


def _monthly(spark, folder) -> DataFrame:
    w = _warehouse(spark, folder)
    return finance.period_totals(w.fact_orders, w.dim_dates)


@query
def monthly_distinct(spark, folder):
    return _monthly(spark, folder).select("year", "month", "total_orders", "unique_customers")


@query
def monthly_sums(spark, folder):
    return _monthly(spark, folder).select(
        "year", "month", "total_revenue", "total_profit", "avg_order_value",
        "total_quantity_sold",
    )


@query
def month_lag(spark, folder):
    lagged = finance.with_previous(_monthly(spark, folder), ["year", "month"])
    return lagged.select(
        "year", "month", "total_revenue", "total_orders", "prev_revenue", "prev_orders"
    )


@query
def revenue_without_fallback(spark, folder):
    w = _warehouse(spark, folder)
    return finance.revenue_analysis(
        w.fact_orders, w.dim_dates, AS_OF_TIME, exclude_fallback=True
    )


@query
def quarterly_revenue(spark, folder):
    w = _warehouse(spark, folder)
    return finance.quarterly_revenue(w.fact_orders, w.dim_dates)


@query
def order_volume(spark, folder):
    return finance.order_volume(_warehouse(spark, folder).revenue_analysis)


@query
def customer_value(spark, folder):
    w = _warehouse(spark, folder)
    return finance.customer_value(w.fact_orders, w.dim_customers)


@query
def segment_value(spark, folder):
    w = _warehouse(spark, folder)
    return finance.segment_value(
        finance.customer_value(w.fact_orders, w.dim_customers)
    )


@query
def margin_by_tier(spark, folder):
    w = _warehouse(spark, folder)
    return finance.margin_by_tier(w.fact_orders, w.dim_products)


# Verification --------------------------------------------------------------------------


@query
def star_sample_full(spark, folder):
    return verify.star_sample(**adapt(spark, folder))


@query
def recent_orders(spark, folder):
    return verify.recent_orders(**adapt(spark, folder))


@query
def sample_orders(spark, folder):
    return verify.sample_orders(**adapt(spark, folder))


@query
def sample_facts(spark, folder):
    columns = ["order_key", "customer_key", "product_key", "quantity", "total_amount"]
    return verify.sample_rows(_warehouse(spark, folder).fact_orders, columns, order=columns)


@query
def latest_months(spark, folder):
    return verify.latest_months(_warehouse(spark, folder).revenue_analysis, 5)


@query
def latest_year(spark, folder):
    return verify.latest_months(_warehouse(spark, folder).revenue_analysis, 12)


@query
def missing_dates(spark, folder):
    orders = _warehouse(spark, folder).stg_orders
    return verify.missing_dates(
        orders, dim_dates(date_spine(spark, end=SHORT_CALENDAR_END))
    )


@query
def date_coverage(spark, folder):
    w = _warehouse(spark, folder)
    return verify.date_coverage(w.orders, w.dim_dates)


@query
def orphan_keys(spark, folder):
    """Order keys of customers that are inactive, hence not in the dimension."""
    w = _warehouse(spark, folder)
    return verify.orphan_keys(w.stg_orders, w.dim_customers, "customer_id")


@query
def orphan_fact_keys(spark, folder):
    w = _warehouse(spark, folder)
    return verify.orphan_keys(w.fact_orders, w.dim_customers, "customer_key")


@query
def duplicate_keys(spark, folder):
    return verify.duplicate_keys(adapt(spark, folder)["orders"], ORDER_KEYS)


@query
def row_counts(spark, folder):
    w = _warehouse(spark, folder)
    layers = {
        "source": ("customers", "products", "orders"),
        "staging": ("stg_customers", "stg_products", "stg_orders"),
        "core": ("dim_customers", "dim_products", "dim_dates", "fact_orders"),
        "finance": ("revenue_analysis",),
    }
    return verify.row_counts(
        {f"{s}.{n}": getattr(w, n) for s, names in layers.items() for n in names}
    )


@query
def reconciliation(spark, folder):
    """Orders against a copy that lost some, holds some twice and has wrong cells in others."""
    orders = adapt(spark, folder)["orders"].drop("shipping_address")
    copy = orders.where("order_id % 101 <> 0").withColumn(
        "total_amount",
        F.when(F.col("order_id") % 97 == 0, (F.col("total_amount") + 1).cast("decimal(10,2)"))
        .otherwise(F.col("total_amount")),
    )
    copy = copy.unionByName(orders.where("order_id % 103 = 0"))
    found = reconcile(orders, copy, "order_id", ["order_id", "customer_id", "order_date", "quantity", "total_amount"])
    return found.withColumn("differs_in", F.array_join("differs_in", ","))


@query
def load_counts(spark, folder):
    """Row counts of the landing tables, as they are verified after a load."""
    landed = {
        name: landing.normalize_names(
            landing.fit_widths(landing.conform(df, LANDING[name]), WIDTHS.get(name, {}))
        )
        for name, df in adapt(spark, folder).items()
    }
    return verify.verify_landing(landed)["row_counts"]


@query
def incremental_fact(spark, folder):
    """The fact after a batch in which pending orders complete and shipped ones are cancelled.

    The batch names one row of each changed order; all rows of the order are derived anew.
    """
    w = _warehouse(spark, folder)
    status = F.col("order_status")
    becomes = F.when(status == "PENDING", "COMPLETED").when(status == "SHIPPED", "CANCELLED")
    landed = w.orders.withColumn("order_status", F.coalesce(becomes, status))
    batch = w.orders.where(status.isin("PENDING", "SHIPPED")).groupBy("order_id").agg(F.min("product_id"))
    return merge_fact(
        w.fact_orders, landed, batch, w.dim_customers, w.dim_products, w.dim_dates, AS_OF_TIME
    )


# Orders per range of the states: small, so that the test tables have several.
STATE_WIDTH = 1000


def _state_totals(spark, folder, kind) -> DataFrame:
    w = _warehouse(spark, folder)
    sums = rollup.sum_states(w.fact_orders, w.dim_dates, STATE_WIDTH)
    members = rollup.member_states(w.fact_orders, w.dim_customers, w.dim_dates, STATE_WIDTH)
    return rollup.merged_totals(sums, members, w.dim_dates, kind)


@query
def rollup_months(spark, folder):
    """The monthly mart from mergeable states of ranges of the fact."""
    return finance.period_report(_state_totals(spark, folder, finance.MONTHS))


@query
def rollup_quarters(spark, folder):
    totals = _state_totals(spark, folder, finance.QUARTERS)
    return finance.period_report(totals, finance.QUARTERS)


# Checks --------------------------------------------------------------------------------


@query
def check_unique(spark, folder):
    stg_orders = _warehouse(spark, folder).stg_orders
    return quality.check_unique(stg_orders, ["order_key", "order_id", "customer_id"])


@query
def check_not_null(spark, folder):
    orders = adapt(spark, folder)["orders"]
    return quality.check_not_null(orders, orders.columns)


@query
def check_relationship(spark, folder):
    w = _warehouse(spark, folder)
    return quality.check_relationship(
        w.orders, "product_id", w.dim_products, "product_id"
    )


@query
def check_suite(spark, folder):
    return quality.run_suite(_warehouse(spark, folder).tables())


@query
def freshness(spark, folder):
    tables = adapt(spark, folder)
    limits = {"warn_after": dt.timedelta(days=1), "error_after": dt.timedelta(days=30)}
    orders, customers = (
        quality.check_freshness(tables[n], n, "updated_at", as_of=AS_OF_TIME, **limits)
        for n in ("orders", "customers")
    )
    return orders.unionByName(customers)


# Landing -------------------------------------------------------------------------------


@query
def landing_read(spark, folder):
    return landing.normalize_names(read_table(spark, folder, "orders"))


@query
def conform(spark, folder):
    """Orders that arrive as text under names in capitals, made orders again."""
    orders = landing.normalize_names(adapt(spark, folder)["orders"])
    as_text = orders.select([F.col(c).cast("string").alias(c) for c in orders.columns])
    return landing.conform(as_text, LANDING["orders"])


@query
def fill_defaults(spark, folder):
    orders = adapt(spark, folder)["orders"].drop(
        "quantity", "discount_amount", "order_status", "payment_method"
    )
    return landing.fill_defaults(orders, column_defaults("orders"))


@query
def truncate_to(spark, folder):
    return landing.truncate_to(adapt(spark, folder)["products"], NARROW_WIDTHS)


def _customer_changes(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Customers, and a change set: the inactive ones revived, suppliers added."""
    customers = adapt(spark, folder)["customers"]
    revived = customers.where(~F.col("is_active")).withColumn("is_active", F.lit(True))
    suppliers = read_table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + NEW_CUSTOMER_BASE).alias("customer_id"),
        F.col("s_name").alias("first_name"),
        F.lit("supplier").alias("last_name"),
        F.concat("s_name", F.lit("@example.com")).alias("email"),
        F.lit(AS_OF).alias("registration_date"),
        F.lit(AS_OF_TIME.isoformat(" ")).cast("timestamp_ntz").alias("created_at"),
        F.lit(AS_OF_TIME.isoformat(" ")).cast("timestamp_ntz").alias("updated_at"),
    )
    added = landing.fill_defaults(suppliers, column_defaults("customers"))
    return customers, revived.unionByName(added, allowMissingColumns=True)


@query
def upsert(spark, folder):
    customers, changes = _customer_changes(spark, folder)
    return landing.upsert(customers, changes, "customer_id")


TOUCHED = dt.datetime(2001, 8, 3, 12, 30)


@query
def touch_updated_at(spark, folder):
    customers, changes = _customer_changes(spark, folder)
    return landing.touch_updated_at(changes, customers, "customer_id", TOUCHED)


@query
def latest_changes(spark, folder):
    return landing.latest_changes(adapt(spark, folder)["orders"], ORDER_KEYS, "updated_at")


@query
def ordered_merge(spark, folder):
    """Orders after later, deleting and earlier changes that arrive in this order."""
    orders = adapt(spark, folder)["orders"]

    def batch(divisor, days, deleted, **changes):
        chosen = orders.where(F.col("customer_id") % divisor == 0)
        stamp = F.col("updated_at") + F.make_dt_interval(F.lit(days))
        new = {"updated_at": stamp, "is_deleted": F.lit(deleted)}
        return chosen.withColumns(new | {c: F.lit(v) for c, v in changes.items()})

    stored = orders.withColumn("is_deleted", F.lit(False))
    for changes in (
        batch(5, 10, False, order_status="COMPLETED"),
        batch(7, 7, True),
        batch(3, 5, False, order_status="CANCELLED"),
    ):
        stored = landing.merge_ordered(stored, changes, ORDER_KEYS, "updated_at", "is_deleted")
    return landing.live_rows(stored, "is_deleted")


# Generated data, for the ids and reference tables given --------------------------------


def _without_stamps(df: DataFrame) -> DataFrame:
    return df.drop("created_at", "updated_at")


@query
def _synth_customers(spark, folder):
    ids = read_table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"))
    return _without_stamps(synth_customers(ids, SEED, AS_OF))


@query
def _synth_products(spark, folder):
    ids = read_table(spark, folder, "part").select(F.col("p_partkey").alias("product_id"))
    return _without_stamps(synth_products(ids, SEED))


@query
def _synth_orders(spark, folder):
    ids = read_table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_id"))
    tables = adapt(spark, folder)
    return _without_stamps(
        synth_orders(ids, tables["customers"], tables["products"], SEED, AS_OF)
    )
