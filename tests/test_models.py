"""Each branch of each model on hand-made rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

import fixtures as fx
from salesmart.functions.keys import surrogate_key
from salesmart.operators.calendar import covering_bounds, date_spine, spine_between
from salesmart.plans.build import RunOptions, Warehouse
from salesmart.plans.dimensions import dim_customers, dim_dates, dim_products
from salesmart.plans.finance import margin_by_tier, revenue_analysis
from salesmart.plans.staging import stg_customers, stg_orders, stg_products

D = Decimal


def build(spark, orders=(), customers=None, products=None, **options):
    sources = {
        "customers": fx.customers(spark, *(customers or [{"customer_id": 1}])),
        "products": fx.products(spark, *(products or [{"product_id": 1}])),
        "orders": fx.orders(spark, *orders),
    }
    return Warehouse(sources, RunOptions(as_of=fx.AS_OF, run_ts=fx.RUN, **options))


# Customers


@pytest.mark.parametrize(
    "days, tenure",
    [(0, "NEW"), (90, "NEW"), (91, "RECENT"), (365, "RECENT"), (366, "ESTABLISHED"),
     (None, "ESTABLISHED"), (-1, "NEW")],
)
def test_tenure(spark, days, tenure):
    day = None if days is None else fx.AS_OF - dt.timedelta(days=days)
    rows = fx.customers(spark, {"customer_id": 1, "registration_date": day})
    assert dim_customers(stg_customers(rows), fx.AS_OF).first().customer_tenure == tenure


def test_customer_cleaning(spark):
    rows = fx.customers(spark, {
        "customer_id": 7, "first_name": " ada ", "last_name": "Byron ", "email": " A@X.Com ",
        "customer_segment": None, "city": " Leeds ",
    })
    got = dim_customers(stg_customers(rows), fx.AS_OF, fx.RUN).first()
    assert (got.first_name, got.last_name, got.full_name) == ("ADA", "BYRON", "ADA BYRON")
    assert (got.email, got.customer_segment, got.city) == ("a@x.com", "UNKNOWN", " Leeds ")
    assert got.customer_key == "8f14e45fceea167a5a36dedd4bea2543"  # md5 of "7"
    assert (got.dw_created_at, got.dw_updated_at) == (fx.RUN, fx.RUN)


def test_full_name_needs_both_parts(spark):
    rows = fx.customers(spark, {"customer_id": 1, "first_name": None})
    assert dim_customers(stg_customers(rows), fx.AS_OF).first().full_name is None


@pytest.mark.parametrize("flag", [False, None])
def test_inactive_rows_are_absent(spark, flag):
    assert stg_customers(fx.customers(spark, {"customer_id": 1, "is_active": flag})).isEmpty()
    assert stg_products(fx.products(spark, {"product_id": 1, "is_active": flag})).isEmpty()


# Products


@pytest.mark.parametrize(
    "price, cost, margin, margin_tier, price_tier",
    [
        (100, 50, "50.00", "HIGH", "MID-RANGE"),
        (1000, 750, "25.00", "MEDIUM", "PREMIUM"),
        ("99.99", 80, "19.99", "LOW", "BUDGET"),
        (80, 100, "-25.00", "LOW", "BUDGET"),
        (3, 1, "66.67", "HIGH", "BUDGET"),
        (800, "399.96", "50.01", "HIGH", "MID-RANGE"),  # 50.005 exactly: half up
        (800, "1200.04", "-50.01", "LOW", "MID-RANGE"),
        (100, None, None, "LOW", "MID-RANGE"),
    ],
)
def test_product_tiers(spark, price, cost, margin, margin_tier, price_tier):
    rows = fx.products(spark, {"product_id": 1, "unit_price": price, "cost_price": cost})
    got = dim_products(stg_products(rows)).first()
    assert got.profit_margin_pct == (None if margin is None else D(margin))
    assert (got.profit_margin_tier, got.price_tier) == (margin_tier, price_tier)


def test_zero_price(spark):
    rows = fx.products(spark, {"product_id": 1, "unit_price": 0})
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        stg_products(rows).collect()
    assert stg_products(rows, safe=True).first().profit_margin_pct is None


def test_product_cleaning(spark):
    rows = fx.products(spark, {
        "product_id": 1, "product_name": " Desk Lamp ", "category": " home ",
        "subcategory": " light", "brand": " Acme ", "supplier": " Sup ",
    })
    got = stg_products(rows).first()
    assert (got.product_name, got.category, got.subcategory) == ("Desk Lamp", "HOME", "LIGHT")
    assert (got.brand, got.supplier) == ("ACME", "Sup")


# Orders and the fact


@pytest.mark.parametrize(
    "status, kept",
    [("COMPLETED", True), ("SHIPPED", True), ("DELIVERED", True), ("PENDING", False),
     ("CANCELLED", False), (None, False), ("completed", False)],
)
def test_fulfilled_orders(spark, status, kept):
    rows = stg_orders(fx.orders(spark, {"order_status": status}))
    assert rows.count() == kept


def test_staged_order(spark):
    got = stg_orders(fx.orders(spark, {"order_id": 5, "discount_amount": None})).first()
    assert got.order_date == dt.date(2024, 3, 5)
    assert (got.discount_amount, got.tax_amount) == (D("0.00"), D("16.00"))
    keyed = spark.range(1).select(surrogate_key_of(spark, "5-1")).first()[0]
    assert got.order_key == keyed


def surrogate_key_of(spark, text):
    from pyspark.sql import functions as F

    return F.md5(F.lit(text))


@pytest.mark.parametrize(
    "total, cost, profit, margin",
    [("216", 50, "116.00", "116.00"), ("60", 50, "-40.00", "-40.00"),
     ("216", "0", "216.00", "0.00"), ("216", None, "216.00", "0.00"),
     ("799.99", 400, "-0.01", "0.00"), ("799.96", 400, "-0.04", "-0.01"),
     ("800.04", 400, "0.04", "0.01")],
)
def test_measures(spark, total, cost, profit, margin):
    fact = build(
        spark, [{"total_amount": total, "discount_amount": None}],
        products=[{"product_id": 1, "cost_price": cost}],
    ).fact_orders.first()
    assert (fact.gross_amount, fact.net_amount) == (D("200.00"), D("200.00"))
    assert fact.total_cost == 2 * D(str(cost or 0))
    assert (fact.profit_amount, fact.profit_margin_pct) == (D(profit), D(margin))


def test_missing_dimensions(spark):
    w = build(
        spark,
        [{"order_id": 1, "customer_id": 2, "product_id": 2}, {"order_id": 2, "customer_id": None,
                                                             "product_id": None}],
        customers=[{"customer_id": 1}, {"customer_id": 2, "is_active": False}],
        products=[{"product_id": 1}, {"product_id": 2, "is_active": False}],
    )
    for fact in w.fact_orders.collect():
        assert fact.customer_key is None and fact.product_key is None
        assert (fact.total_cost, fact.profit_amount) == (D("0.00"), D("216.00"))
        assert fact.profit_margin_pct == D("0.00")


@pytest.mark.parametrize(
    "day, flag",
    [(None, 1), (dt.datetime(2030, 12, 31), 1), (dt.datetime(2031, 1, 1), 1),
     (dt.datetime(2030, 12, 30, 23, 59), 0), (dt.datetime(1900, 1, 1), 0)],
)
def test_undated_orders(spark, day, flag):
    w = build(spark, [{"order_date": day}])
    fact = w.fact_orders.first()
    assert fact.missing_date_flag == flag
    booked = dt.date(1900, 1, 1) if flag else day.date()
    assert w.dim_dates.where(f"date_key = '{fact.date_key}'").first().full_date == booked


def test_fact_keys_are_the_dimension_keys(spark):
    w = build(spark, [{}])
    fact = w.fact_orders.first()
    assert fact.order_key == w.stg_orders.first().order_key
    assert fact.customer_key == w.dim_customers.first().customer_key
    assert fact.product_key == w.dim_products.first().product_key


def test_null_key_marker(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    got = df.select(surrogate_key("a", "b").alias("k"), surrogate_key("b").alias("n")).first()
    want = df.selectExpr(
        "md5('1-_dbt_utils_surrogate_key_null_')", "md5('_dbt_utils_surrogate_key_null_')"
    ).first()
    assert tuple(got) == tuple(want)


# Calendar


def test_calendar_days(spark):
    days = {r.full_date: r for r in dim_dates(date_spine(spark)).collect()}
    assert len(days) == 47_846
    assert min(days) == dt.date(1900, 1, 1) and max(days) == dt.date(2030, 12, 30)
    weekend = [days[dt.date(2024, 1, d)] for d in (6, 7, 8)]
    assert [r.is_weekend for r in weekend] == [True, True, False]
    assert [r.day_name for r in weekend] == ["Sat", "Sun", "Mon"]
    assert [r.day_of_week for r in weekend] == [7, 1, 2]
    assert days[dt.date(2024, 7, 4)].is_holiday and days[dt.date(1900, 1, 1)].is_holiday
    assert not days[dt.date(2023, 7, 4)].is_holiday
    new_year = days[dt.date(2023, 1, 1)]
    assert (new_year.week_of_year, new_year.quarter_name, new_year.month_year) == (
        52, "Q1 2023", "Jan 2023")


def test_spines_agree(spark):
    start, end = dt.date(2024, 2, 27), dt.date(2024, 3, 2)
    literal = [r[0] for r in date_spine(spark, start, end).collect()]
    bounds = spark.createDataFrame([(start, end)], "start date, end date")
    assert literal == [r[0] for r in spine_between(bounds).collect()]
    assert literal == [start + dt.timedelta(days=i) for i in range(4)]
    assert date_spine(spark, end, start).isEmpty()


def test_covering_bounds(spark):
    rows = fx.orders(spark, {"order_date": dt.datetime(2031, 5, 6, 12)}, {"order_date": None})
    got = covering_bounds(rows, "order_date", dt.date(2000, 1, 1), dt.date(2030, 1, 1)).first()
    assert tuple(got) == (dt.date(2000, 1, 1), dt.date(2031, 5, 7))


# The mart


def month(i, **row):
    return {"order_date": dt.datetime(2024, i, 15), **row}


def test_growth_skips_empty_months(spark):
    mart = build(
        spark,
        [month(1, order_id=1, total_amount=100), month(3, order_id=2, total_amount=150)],
    ).revenue_analysis.collect()
    assert [(r.month_name, r.revenue_growth_pct) for r in mart] == [
        ("Jan", None), ("Mar", D("50.00"))]


@pytest.mark.parametrize("before", [0, -5])
def test_no_growth_on_nothing(spark, before):
    w = build(
        spark, [month(1, total_amount=before), month(2, order_id=2, total_amount=10)], safe=True
    )
    first, second = w.revenue_analysis.collect()
    assert second.revenue_growth_pct is None
    assert (first.profit_margin_pct is None) == (before == 0)


def test_zero_revenue_fails_unless_safe(spark):
    w = build(spark, [month(1, total_amount=0)])
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        w.revenue_analysis.collect()


def test_order_growth(spark):
    rows = [month(1, order_id=i) for i in range(3)] + [month(2, order_id=9 + i) for i in range(2)]
    assert build(spark, rows).revenue_analysis.collect()[1].order_growth_pct == D("-33.33")


def test_month_counts(spark):
    w = build(
        spark,
        [month(1, order_id=1, total_amount=10), month(1, order_id=1, product_id=2,
                                                    total_amount=20),
         month(1, order_id=2, customer_id=99, total_amount=40)],
    )
    got = w.revenue_analysis.first()
    assert (got.total_orders, got.unique_customers, got.total_quantity_sold) == (2, 1, 6)
    assert (got.total_revenue, got.avg_order_value) == (D("70.00"), D("23.333333"))


def test_fallback_month_can_be_left_out(spark):
    w = build(spark, [month(1), {"order_id": 2, "order_date": None}])
    assert [r.year for r in w.revenue_analysis.collect()] == [1900, 2024]
    kept = revenue_analysis(w.fact_orders, w.dim_dates, exclude_fallback=True).collect()
    assert [(r.year, r.revenue_growth_pct) for r in kept] == [(2024, None)]


def test_tier_margin(spark):
    w = build(
        spark, [{"total_amount": 200}, {"order_id": 2, "product_id": 2, "total_amount": 400}],
        products=[{"product_id": 1}, {"product_id": 2}],
    )
    got = margin_by_tier(w.fact_orders, w.dim_products).collect()
    assert [(r.products, r.order_rows, r.profit_margin_pct) for r in got] == [
        (2, 2, D("66.67"))]
