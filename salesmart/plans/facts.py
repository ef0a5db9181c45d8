"""The order fact."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.audit import stamped
from salesmart.functions.keys import surrogate_key
from salesmart.functions.money import AMOUNT, PERCENT, PRICE, cents_percent, to_cents
from salesmart.operators.calendar import FALLBACK_DAY
from salesmart.operators.joins import lookup_join
from salesmart.plans.staging import stg_orders


def rebuilt_orders(
    orders: DataFrame,
    changed: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame,
    dim_dates: DataFrame,
    run_ts: dt.datetime | None = None,
) -> DataFrame:
    """The fact rows of the orders whose ids ``changed`` lists, from all their rows in ``orders``."""
    whole = orders.join(changed.select("order_id").distinct(), "order_id", "left_semi")
    return fact_orders(stg_orders(whole), dim_customers, dim_products, dim_dates, run_ts)


def merge_fact(
    fact: DataFrame,
    orders: DataFrame,
    changed: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame,
    dim_dates: DataFrame,
    run_ts: dt.datetime | None = None,
) -> DataFrame:
    """``fact`` with the orders that ``changed`` lists built anew from the landed ``orders``.

    Whole orders change: an order key need not be single, so every row of a listed order
    leaves the fact and every landed row of it that is fulfilled comes back. The dimensions'
    keys are functions of ids, so rows that did not change keep theirs. To write only the
    ranges that change, see ``plans.incremental``.
    """
    made = rebuilt_orders(orders, changed, dim_customers, dim_products, dim_dates, run_ts)
    ids = changed.select("order_id").distinct()
    return fact.join(ids, "order_id", "left_anti").select(*fact.columns).unionByName(made)


def fact_orders(
    stg_orders: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame,
    dim_dates: DataFrame,
    run_ts: dt.datetime | None = None,
    fallback_day: dt.date = FALLBACK_DAY,
    salts: int = 1,
) -> DataFrame:
    """One row per staged order with its dimension keys and measures.

    Orders keep their place when a dimension row is missing: customer and product key are
    NULL, the product's cost counts as 0, and the date key is that of ``fallback_day``
    with ``missing_date_flag`` set.

    The joins run on the short natural keys. Surrogate keys are a function of these, so
    order, customer and product keys are made after the joins: rows cross the shuffles
    without three 32-byte strings, and the lookups hold an id and a price only.
    """
    orders = stg_orders.select(
        "order_id", "customer_id", "product_id", "order_date", "quantity", "unit_price",
        "discount_amount", "tax_amount", "total_amount", "order_status", "payment_method",
        "created_at",
    )
    customers = dim_customers.select("customer_id", F.lit(True).alias("known_customer"))
    products = dim_products.select(
        "product_id", F.lit(True).alias("known_product"), "cost_price"
    )
    days = dim_dates.select(
        F.col("full_date").alias("order_date"), F.col("date_key").alias("matched_date_key")
    )
    fallback_key = dim_dates.where(F.col("full_date") == fallback_day).select("date_key")

    joined = lookup_join(orders, customers, "customer_id", salts=salts, spread_by="order_id")
    joined = lookup_join(joined, products, "product_id", salts=salts, spread_by="order_id")
    joined = lookup_join(joined, days, "order_date")

    gross = F.col("quantity") * F.col("unit_price")
    cost = F.col("quantity") * F.coalesce("cost_price", F.lit(0).cast(PRICE))
    measured = joined.select(
        surrogate_key("order_id", "product_id").alias("order_key"),
        F.when(F.col("known_customer"), surrogate_key("customer_id")).alias("customer_key"),
        F.when(F.col("known_product"), surrogate_key("product_id")).alias("product_key"),
        F.coalesce("matched_date_key", fallback_key.scalar()).alias("date_key"),
        "order_id",
        "quantity",
        "unit_price",
        "discount_amount",
        "tax_amount",
        "total_amount",
        gross.cast(AMOUNT).alias("gross_amount"),
        (gross - F.col("discount_amount")).cast(AMOUNT).alias("net_amount"),
        cost.cast(AMOUNT).alias("total_cost"),
        (F.col("total_amount") - cost).cast(AMOUNT).alias("profit_amount"),
        "order_status",
        "payment_method",
        "created_at",
        F.col("matched_date_key").isNull().cast("int").alias("missing_date_flag"),
    )
    in_cents = measured.withColumns({
        "profit_cents": to_cents(F.col("profit_amount")),
        "cost_cents": to_cents(F.col("total_cost")),
    })
    # Guarded, unlike the other percentages: no cost means a margin of zero.
    margin = F.when(
        F.col("cost_cents") > 0, cents_percent(F.col("profit_cents"), F.col("cost_cents"))
    ).otherwise(F.lit(0).cast(PERCENT))
    columns = measured.columns
    place = columns.index("profit_amount") + 1
    fact = in_cents.select(
        *columns[:place], margin.alias("profit_margin_pct"), *columns[place:]
    )
    return stamped(fact, run_ts)
