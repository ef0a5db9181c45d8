"""Staging models: one narrow pass over each landing table, no shuffle.

The row filters come first and touch plain columns only, so they reach the Parquet scan.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.keys import surrogate_key
from salesmart.functions.money import PRICE, percent

# Order states that count as fulfilled.
FULFILLED = ("COMPLETED", "SHIPPED", "DELIVERED")
UNKNOWN_SEGMENT = "UNKNOWN"


def _clean(name: str):
    return F.trim(F.col(name)).alias(name)


def _clean_upper(name: str):
    return F.upper(F.trim(F.col(name))).alias(name)


def stg_customers(customers: DataFrame) -> DataFrame:
    """Active customers, keyed, with names in capitals and emails in small letters."""
    return customers.where("is_active").select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id",
        _clean_upper("first_name"),
        _clean_upper("last_name"),
        F.lower(F.trim("email")).alias("email"),
        "phone",
        "address_line_1",
        "address_line_2",
        "city",
        "state",
        "country",
        "postal_code",
        "registration_date",
        F.coalesce("customer_segment", F.lit(UNKNOWN_SEGMENT)).alias("customer_segment"),
        "created_at",
        "updated_at",
    )


def stg_products(products: DataFrame, safe: bool = False) -> DataFrame:
    """Active products, keyed, with the margin as a percentage of the price.

    A price of zero fails the query, or gives a NULL margin with ``safe``.
    """
    price, cost = F.col("unit_price"), F.col("cost_price")
    return products.where("is_active").select(
        surrogate_key("product_id").alias("product_key"),
        "product_id",
        _clean("product_name"),
        _clean_upper("category"),
        _clean_upper("subcategory"),
        _clean_upper("brand"),
        _clean("supplier"),
        "unit_price",
        "cost_price",
        percent(price - cost, price, safe).alias("profit_margin_pct"),
        "description",
        "created_at",
        "updated_at",
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    """Fulfilled orders, keyed by order and product, dated by day."""
    none = F.lit(0).cast(PRICE)
    return orders.where(F.col("order_status").isin(*FULFILLED)).select(
        surrogate_key("order_id", "product_id").alias("order_key"),
        "order_id",
        "customer_id",
        "product_id",
        F.to_date("order_date").alias("order_date"),
        "quantity",
        "unit_price",
        F.coalesce("discount_amount", none).alias("discount_amount"),
        F.coalesce("tax_amount", none).alias("tax_amount"),
        "total_amount",
        "order_status",
        "payment_method",
        "shipping_address",
        "created_at",
        "updated_at",
    )
