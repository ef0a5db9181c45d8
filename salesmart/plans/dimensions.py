"""The three dimensions."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.audit import business_date, stamped
from salesmart.functions.keys import surrogate_key
from salesmart.operators.calendar import HOLIDAYS

# Tenure limits in days since registration; tier limits.
NEW_DAYS, RECENT_DAYS = 90, 365
HIGH_MARGIN, MEDIUM_MARGIN = 50, 25
PREMIUM_PRICE, MID_PRICE = 1000, 100


def dim_customers(
    stg_customers: DataFrame,
    as_of: dt.date | None = None,
    run_ts: dt.datetime | None = None,
) -> DataFrame:
    """Customers with full name and tenure on ``as_of``.

    The full name is NULL when either part is; an unknown registration day counts as
    established.
    """
    today = business_date(as_of)
    registered = F.col("registration_date")
    tenure = (
        F.when(registered >= F.date_sub(today, NEW_DAYS), "NEW")
        .when(registered >= F.date_sub(today, RECENT_DAYS), "RECENT")
        .otherwise("ESTABLISHED")
    )
    named = stg_customers.select(
        "customer_key", "customer_id", "first_name", "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email", "phone", "address_line_1", "address_line_2", "city", "state", "country",
        "postal_code", "registration_date", "customer_segment",
        tenure.alias("customer_tenure"),
        "created_at", "updated_at",
    )
    return stamped(named, run_ts)


def dim_products(stg_products: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Products with margin and price tiers."""
    margin, price = F.col("profit_margin_pct"), F.col("unit_price")
    margin_tier = (
        F.when(margin >= HIGH_MARGIN, "HIGH").when(margin >= MEDIUM_MARGIN, "MEDIUM")
        .otherwise("LOW")
    )
    price_tier = (
        F.when(price >= PREMIUM_PRICE, "PREMIUM").when(price >= MID_PRICE, "MID-RANGE")
        .otherwise("BUDGET")
    )
    tiered = stg_products.select(
        "product_key", "product_id", "product_name", "category", "subcategory", "brand",
        "supplier", "unit_price", "cost_price", "profit_margin_pct",
        margin_tier.alias("profit_margin_tier"), price_tier.alias("price_tier"),
        "description", "created_at", "updated_at",
    )
    return stamped(tiered, run_ts)


def dim_dates(
    spine: DataFrame,
    holidays: Sequence[dt.date] = HOLIDAYS,
    run_ts: dt.datetime | None = None,
) -> DataFrame:
    """The calendar over a spine of days (see ``operators.calendar``).

    Weeks are ISO weeks; days of the week count from 1 = Sunday.
    """
    day = F.col("full_date")
    dated = spine.select(F.col("date_day").alias("full_date")).select(
        surrogate_key("full_date").alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayname(day).alias("day_name"),
        F.monthname(day).alias("month_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        day.isin(*holidays).alias("is_holiday"),
        F.concat(F.lit("Q"), F.quarter(day), F.lit(" "), F.year(day)).alias("quarter_name"),
        F.concat(F.monthname(day), F.lit(" "), F.year(day)).alias("month_year"),
    )
    return stamped(dated, run_ts)
