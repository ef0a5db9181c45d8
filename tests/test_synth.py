"""Invariants of the generated tables."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salesmart.schemas import CUSTOMERS, ORDERS, PRODUCTS
from salesmart.sources import synth
from salesmart.sources.synth import (
    dense_index, identities, synth_customers, synth_orders, synth_products,
)

AS_OF = dt.date(2024, 6, 30)


@pytest.fixture(scope="module")
def made(spark):
    people = synth_customers(identities(spark, 1000, "customer_id"), 1, AS_OF)
    goods = synth_products(identities(spark, 500, "product_id"), 1)
    sold = synth_orders(identities(spark, 5000, "order_id"), people, goods, 1, AS_OF)
    return {n: df.persist() for n, df in
            (("customers", people), ("products", goods), ("orders", sold))}


def values(df, column):
    return {r[0] for r in df.select(column).distinct().collect()}


def test_customers(made):
    df = made["customers"]
    assert df.schema.simpleString() == CUSTOMERS.simpleString()
    assert df.count() == 1000 and df.select("email").distinct().count() == 1000
    assert values(df, "customer_segment") == set(synth.SEGMENTS)
    assert values(df, "country") == {"USA"} and values(df, "is_active") == {True}
    first, last = df.agg(F.min("registration_date"), F.max("registration_date")).first()
    assert dt.date(2022, 7, 1) <= first and last <= AS_OF
    assert (last - first).days > 650


def test_products(made):
    df = made["products"]
    assert df.schema.simpleString() == PRODUCTS.simpleString()
    pairs = {tuple(r) for r in df.select("category", "subcategory").distinct().collect()}
    assert pairs == {(c, s) for c, subs in synth.CATEGORIES.items() for s in subs}
    assert values(df, "brand") == set(synth.BRANDS)
    assert values(df, "supplier") == set(synth.SUPPLIERS)
    for r in df.collect():
        assert Decimal(10) <= r.cost_price <= Decimal(500)
        assert r.cost_price * Decimal("1.19") < r.unit_price <= r.cost_price * 3


def test_orders(made):
    df = made["orders"]
    assert df.schema.simpleString() == ORDERS.simpleString() and df.count() == 5000
    prices = {r.product_id: r.unit_price for r in made["products"].collect()}
    people = values(made["customers"], "customer_id")
    for r in df.collect():
        gross = r.quantity * r.unit_price
        assert r.unit_price == prices[r.product_id] and r.customer_id in people
        assert r.total_amount == gross - r.discount_amount + r.tax_amount
        assert 0 <= r.discount_amount <= gross * Decimal("0.2") + Decimal("0.01")
        assert abs(r.tax_amount - gross * Decimal("0.08")) <= Decimal("0.005")
    assert values(df, "quantity") == {1, 2, 3, 4, 5}
    assert values(df, "order_status") == set(synth.STATUSES)
    assert values(df, "payment_method") == set(synth.PAYMENTS)
    first, last = df.agg(F.min("order_date"), F.max("order_date")).first()
    assert dt.datetime(2022, 7, 1) <= first and last <= dt.datetime(2024, 6, 30)
    assert df.select("customer_id").distinct().count() > 950
    assert df.select("product_id").distinct().count() == 500


def test_seed_decides(spark, made):
    def rows(seed, tasks):
        ids = identities(spark, 1000, "customer_id").repartition(tasks)
        made_again = synth_customers(ids, seed, AS_OF).drop("created_at", "updated_at")
        return sorted(tuple(r) for r in made_again.collect())

    kept = made["customers"].drop("created_at", "updated_at")
    assert rows(1, 3) == sorted(tuple(r) for r in kept.collect())
    assert rows(1, 3) != rows(2, 3)


def test_orders_need_both_tables(spark, made):
    with pytest.raises(PySparkException, match="orders need customers"):
        synth_orders(identities(spark, 1, "order_id"), made["customers"].limit(0),
                     made["products"], 1, AS_OF).collect()


def test_no_order_is_lost(spark):
    """NULL, negative, sparse and repeated ids; building starts no job."""
    people = spark.createDataFrame(
        [(1,), (2,), (2,), (-7,), (None,), (1 << 62,), (-(1 << 63),)], "customer_id long"
    )
    goods = spark.createDataFrame(
        [(5, "3.00"), (5, "2.00"), (None, "9.00"), (-(1 << 40), "4.00")],
        "product_id long, unit_price string",
    ).withColumn("unit_price", F.col("unit_price").cast("decimal(10,2)"))
    spark.sparkContext.setJobGroup("orders", "built only")
    made = synth_orders(identities(spark, 1000, "order_id"), people, goods, 1, AS_OF)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("orders")
    rows = made.select("order_id", "customer_id", "product_id", "unit_price").collect()
    assert len(rows) == len({r.order_id for r in rows}) == 1000
    assert {r.customer_id for r in rows} == {1, 2, -7, 1 << 62, -(1 << 63)}
    assert {(r.product_id, str(r.unit_price)) for r in rows} == {(5, "2.00"), (-(1 << 40), "4.00")}


def test_dense_index_of_hashed_keys(spark):
    """The one window without a partition is over two rows: keys below zero, and others."""
    df = spark.range(5000).select(F.xxhash64("id").alias("k"))
    indexed = dense_index(df, "k")
    text = indexed._jdf.queryExecution().executedPlan().toString()
    assert text.count("SinglePartition") == 1
    assert re.search(r"SinglePartition[^\n]*\n[^\n]*HashAggregate\(keys=\[_range3", text)
    got = [r.k for r in indexed.orderBy("place").collect()]
    assert got == sorted(got) and len(got) == 5000


@pytest.mark.parametrize("bits", [8, 16, 33])
def test_dense_index(spark, bits):
    keys = [-(1 << 63), -70_000, -5, 0, 1, 2, 30, 31, 500, 10_000, 1 << 40, (1 << 63) - 1]
    df = spark.createDataFrame([(k,) for k in reversed(keys)], "k long")
    got = {r.place: r.k for r in dense_index(df, "k", bits).collect()}
    assert [got[i] for i in range(len(keys))] == keys
