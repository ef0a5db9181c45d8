"""The finance mart and the business reports built on the star schema."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salesmart.functions.audit import stamped
from salesmart.functions.money import (
    AMOUNT, average, count_percent, from_cents, percent, to_cents,
)


# A kind of calendar period: the column numbering it within the year, and its name.
MONTHS = ("month", "month_name")
QUARTERS = ("quarter", "quarter_name")


def period_totals(
    fact: DataFrame, dim_dates: DataFrame, kind: tuple[str, str] = MONTHS
) -> DataFrame:
    """Orders, customers, revenue, profit and units per calendar period.

    Both exact distinct counts and the sums come from one pass: rows are first reduced to
    distinct (period, order) and (period, customer) pairs, hashed over all of them, so a
    period with most of the rows is not one task's work. These pairs are what is shuffled,
    so they are kept narrow: the period is one number, named afterwards, and amounts are
    summed in cents.

    Orders count once each, however many rows they have; unknown customers are not
    counted; the average is per row.
    """
    period = ["year", *kind]
    number = (F.col("year") * 100 + F.col(kind[0])).alias("period")
    days = dim_dates.select("date_key", number)
    names = dim_dates.select(number, *period).distinct()
    rows = fact.select(
        "date_key",
        "order_id",
        "customer_key",
        to_cents(F.col("total_amount")).alias("revenue"),
        to_cents(F.col("profit_amount")).alias("profit"),
        "quantity",
    )
    totals = rows.join(days, "date_key").groupBy("period").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("customer_key").alias("unique_customers"),
        F.sum("revenue").alias("revenue"),
        F.sum("profit").alias("profit"),
        F.count("revenue").alias("priced_rows"),
        F.sum("quantity").alias("total_quantity_sold"),
    )
    revenue = from_cents(F.col("revenue"))
    return totals.join(names, "period").select(
        *period,
        "total_orders",
        "unique_customers",
        revenue.alias("total_revenue"),
        from_cents(F.col("profit")).alias("total_profit"),
        average(revenue, F.col("priced_rows")).alias("avg_order_value"),
        "total_quantity_sold",
    )


def with_previous(totals: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add revenue and orders of the period listed before (gaps are not filled).

    The window has one partition; its input is one row per calendar period.
    """
    before = W.orderBy(*order)
    return totals.withColumns({
        "prev_revenue": F.lag("total_revenue", 1).over(before),
        "prev_orders": F.lag("total_orders", 1).over(before),
    })


def _growth(value: str, previous: str, ratio) -> Column:
    now, before = F.col(value), F.col(previous)
    return F.when(before > 0, ratio(now - before, before))


def period_report(totals: DataFrame, kind: tuple[str, str] = MONTHS, safe: bool = False) -> DataFrame:
    """Totals per period with margin and growth, in calendar order."""
    order = ["year", kind[0]]
    return (
        with_previous(totals, order)
        .select(
            *order,
            kind[1],
            "total_orders",
            "unique_customers",
            "total_revenue",
            "total_profit",
            percent(F.col("total_profit"), F.col("total_revenue"), safe).alias(
                "profit_margin_pct"
            ),
            "avg_order_value",
            "total_quantity_sold",
            _growth("total_revenue", "prev_revenue", percent).alias("revenue_growth_pct"),
            _growth("total_orders", "prev_orders", count_percent).alias("order_growth_pct"),
        )
        .orderBy(*order)
    )


def revenue_analysis(
    fact: DataFrame,
    dim_dates: DataFrame,
    run_ts: dt.datetime | None = None,
    exclude_fallback: bool = False,
    safe: bool = False,
) -> DataFrame:
    """Monthly revenue, profit, margin, order value and growth, in calendar order.

    Undated orders appear in the fallback day's month unless ``exclude_fallback``. A month
    with zero revenue fails the query, or has a NULL margin with ``safe``.
    """
    if exclude_fallback:
        fact = fact.where("missing_date_flag = 0")
    return stamped(period_report(period_totals(fact, dim_dates), MONTHS, safe), run_ts)


def quarterly_revenue(fact: DataFrame, dim_dates: DataFrame, safe: bool = False) -> DataFrame:
    """The measures of ``revenue_analysis`` by quarter."""
    return period_report(period_totals(fact, dim_dates, QUARTERS), QUARTERS, safe)


def order_volume(mart: DataFrame) -> DataFrame:
    """Order volume, average value and growth by month, from ``revenue_analysis``."""
    return mart.select(
        "year", "month", "total_orders", "avg_order_value", "order_growth_pct"
    )


def customer_value(fact: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Lifetime revenue, profit and orders per known customer with an order.

    The fact is reduced to one row per customer before the join.
    """
    lifetime = fact.where("customer_key is not null").groupBy("customer_key").agg(
        F.sum("total_amount").cast(AMOUNT).alias("lifetime_revenue"),
        F.sum("profit_amount").cast(AMOUNT).alias("lifetime_profit"),
        F.count_distinct("order_id").alias("orders"),
    )
    who = dim_customers.select("customer_key", "full_name", "customer_segment", "customer_tenure")
    return lifetime.join(who, "customer_key").select(
        "customer_key", "full_name", "customer_segment", "customer_tenure",
        "lifetime_revenue", "lifetime_profit", "orders",
    )


def segment_value(customer_values: DataFrame) -> DataFrame:
    """``customer_value`` summed up by segment and tenure."""
    totals = customer_values.groupBy("customer_segment", "customer_tenure").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("lifetime_revenue").cast(AMOUNT).alias("lifetime_revenue"),
        F.sum("lifetime_profit").cast(AMOUNT).alias("lifetime_profit"),
        F.sum("orders").alias("orders"),
    )
    return totals.withColumn(
        "revenue_per_customer", average(F.col("lifetime_revenue"), F.col("customers"))
    )


def margin_by_tier(fact: DataFrame, dim_products: DataFrame, safe: bool = False) -> DataFrame:
    """Revenue, profit and margin by price tier and margin tier.

    The fact is reduced to one row per product before the join.
    """
    per_product = fact.where("product_key is not null").groupBy("product_key").agg(
        F.count(F.lit(1)).alias("order_rows"),
        F.sum("total_amount").alias("total_revenue"),
        F.sum("profit_amount").alias("total_profit"),
    )
    tiers = dim_products.select("product_key", "price_tier", "profit_margin_tier")
    totals = per_product.join(tiers, "product_key").groupBy(
        "price_tier", "profit_margin_tier"
    ).agg(
        F.count(F.lit(1)).alias("products"),
        F.sum("order_rows").alias("order_rows"),
        F.sum("total_revenue").cast(AMOUNT).alias("total_revenue"),
        F.sum("total_profit").cast(AMOUNT).alias("total_profit"),
    )
    margin = percent(F.col("total_profit"), F.col("total_revenue"), safe)
    return totals.withColumn("profit_margin_pct", margin)
