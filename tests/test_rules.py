"""Fixed rules, written down once more apart from the code and its SQL."""

import datetime as dt

import fixtures as fx
from salesmart.operators.calendar import HOLIDAYS
from salesmart.operators.quality import DECLARED
from salesmart.plans.build import RunOptions, build_all
from salesmart.plans.dimensions import dim_products

CHECKS = """
customers unique customer_id, email
customers not_null customer_id, email, first_name, last_name
products unique product_id
products not_null product_id, product_name, unit_price, cost_price
orders not_null order_id, customer_id, product_id, total_amount, quantity
orders relationship customer_id to customers.customer_id, product_id to products.product_id
stg_customers unique customer_key, customer_id, email
stg_customers not_null customer_key, customer_id, email
stg_products unique product_key, product_id
stg_products not_null product_key, product_id, unit_price
stg_orders unique order_key
stg_orders not_null order_key, customer_id, product_id, total_amount
dim_customers unique customer_key, customer_id, email
dim_customers not_null customer_key, customer_id, email
dim_products unique product_key, product_id
dim_products not_null product_key, product_id, unit_price
dim_dates unique date_key, full_date
dim_dates not_null date_key, full_date
fact_orders unique order_key
fact_orders not_null order_key, customer_key, product_key, date_key, total_amount
fact_orders relationship customer_key to dim_customers.customer_key
fact_orders relationship product_key to dim_products.product_key, date_key to dim_dates.date_key
"""


def test_declared_checks():
    expected = set()
    for line in CHECKS.strip().splitlines():
        table, kind, rest = line.split(" ", 2)
        for item in rest.split(", "):
            column, _, parent = item.partition(" to ")
            expected.add((kind, table, column, *(parent.split(".") if parent else (None, None))))
    found = [(c.kind, c.table, c.column, c.parent, c.parent_key) for c in DECLARED]
    assert len(found) == len(set(found)) == 58 and set(found) == expected


def test_holidays():
    assert set(HOLIDAYS) == {dt.date(1900, 1, 1)} | {
        dt.date(year, month, day)
        for year in (2024, 2025, 2026) for month, day in ((1, 1), (7, 4), (12, 25))
    }


def test_tiers_of_unknown_values(spark):
    """A NULL margin is LOW and a NULL price BUDGET, as the last branch of each rule says."""
    from salesmart.plans.staging import stg_products

    staged = stg_products(fx.products(spark, {"product_id": 1}), True)
    nothing = {c: "CAST(NULL AS DECIMAL(10,2))" for c in ("unit_price", "profit_margin_pct")}
    blank = staged.selectExpr(*[f"{nothing.get(c, c)} AS {c}" for c in staged.columns])
    got = dim_products(blank, fx.RUN).first()
    assert (got.profit_margin_tier, got.price_tier) == ("LOW", "BUDGET")


def test_order_of_the_mart(spark):
    mart = build_all(fx.good_sources(spark), RunOptions(as_of=fx.AS_OF))["revenue_analysis"]
    months = [(r.year, r.month) for r in mart.collect()]
    assert months == sorted(months) and len(months) > 1
    assert "Sort [year" in mart._jdf.queryExecution().optimizedPlan().toString()
