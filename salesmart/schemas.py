"""The three landing tables: column types, text widths and column defaults."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.money import PRICE

MONEY = T.DecimalType(10, 2)

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("address_line_1", T.StringType()),
    T.StructField("address_line_2", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("postal_code", T.StringType()),
    T.StructField("registration_date", T.DateType()),
    T.StructField("customer_segment", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("subcategory", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("supplier", T.StringType()),
    T.StructField("unit_price", MONEY),
    T.StructField("cost_price", MONEY),
    T.StructField("description", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", MONEY),
    T.StructField("discount_amount", MONEY),
    T.StructField("tax_amount", MONEY),
    T.StructField("total_amount", MONEY),
    T.StructField("order_status", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("shipping_address", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

LANDING = {"customers": CUSTOMERS, "products": PRODUCTS, "orders": ORDERS}

# Declared text widths of the landing columns.
WIDTHS = {
    "customers": {
        "first_name": 50, "last_name": 50, "email": 100, "phone": 20,
        "address_line_1": 100, "address_line_2": 100, "city": 50, "state": 50,
        "country": 50, "postal_code": 20, "customer_segment": 20,
    },
    "products": {
        "product_name": 200, "category": 50, "subcategory": 50, "brand": 50, "supplier": 100,
    },
    "orders": {"order_status": 20, "payment_method": 20},
}


def column_defaults(table: str) -> dict[str, Column]:
    """Default expressions for columns a source may leave out."""
    now = F.localtimestamp()
    stamps = {"created_at": now, "updated_at": now}
    # The declared defaults.
    return {
        "customers": {
            "country": F.lit("USA"),
            "registration_date": F.current_date(),
            "customer_segment": F.lit("REGULAR"),
            "is_active": F.lit(True),
            **stamps,
        },
        "products": {"is_active": F.lit(True), **stamps},
        "orders": {
            "order_date": now,
            "quantity": F.lit(1),
            "discount_amount": F.lit(0).cast(PRICE),
            "tax_amount": F.lit(0).cast(PRICE),
            "order_status": F.lit("PENDING"),
            "payment_method": F.lit("CREDIT_CARD"),
            **stamps,
        },
    }[table]
