"""Hand-made source rows."""

import datetime as dt
from decimal import Decimal

from salesmart.schemas import CUSTOMERS, ORDERS, PRODUCTS

AS_OF = dt.date(2024, 6, 30)
RUN = dt.datetime(2024, 6, 30, 8, 0)
STAMP = dt.datetime(2024, 1, 1)


def money(value):
    return None if value is None else Decimal(str(value)).quantize(Decimal("0.01"))


def frame(spark, schema, rows, **defaults):
    """Rows given as dicts; columns left out take the default, or NULL."""
    data = [
        tuple({**defaults, **row}.get(f.name) for f in schema.fields) for row in rows
    ]
    return spark.createDataFrame(data, schema)


def customers(spark, *rows):
    return frame(
        spark, CUSTOMERS, rows, first_name="Ann", last_name="Lee", country="USA",
        registration_date=dt.date(2020, 1, 1), customer_segment="VIP", is_active=True,
        created_at=STAMP, updated_at=STAMP,
    )


def products(spark, *rows):
    priced = [
        {**r, **{c: money(r[c]) for c in ("unit_price", "cost_price") if c in r}} for r in rows
    ]
    return frame(
        spark, PRODUCTS, priced, product_name="Lamp", category="home", unit_price=money(100),
        cost_price=money(50), is_active=True, created_at=STAMP, updated_at=STAMP,
    )


AMOUNTS = ("unit_price", "discount_amount", "tax_amount", "total_amount")


def orders(spark, *rows):
    priced = [{**r, **{c: money(r[c]) for c in AMOUNTS if c in r}} for r in rows]
    return frame(
        spark, ORDERS, priced, order_id=1, customer_id=1, product_id=1,
        order_date=dt.datetime(2024, 3, 5, 13, 30), quantity=2, unit_price=money(100),
        tax_amount=money(16), total_amount=money(216), order_status="COMPLETED",
        payment_method="PAYPAL", created_at=STAMP, updated_at=STAMP,
    )


def good_sources(spark):
    """A small consistent set: two customers, two products, three orders."""
    return {
        "customers": customers(
            spark,
            {"customer_id": 1, "email": "a@x.com"}, {"customer_id": 2, "email": "b@x.com"},
        ),
        "products": products(spark, {"product_id": 1}, {"product_id": 2}),
        "orders": orders(
            spark,
            {"order_id": 1},
            {"order_id": 2, "customer_id": 2, "product_id": 2,
             "order_date": dt.datetime(2024, 4, 1)},
            {"order_id": 3, "product_id": 2, "order_date": dt.datetime(2024, 4, 2)},
        ),
    }
