"""The declared checks: silent on good rows, each one raised by a broken copy."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from salesmart.operators import quality, verify
from salesmart.operators.quality import DECLARED, Check
from salesmart.plans.build import RunOptions, Warehouse

TIMES = dict(as_of=fx.AS_OF, run_ts=fx.RUN)


@pytest.fixture(scope="module")
def good(spark):
    short = {"start": dt.date(1900, 1, 1), "end": dt.date(1900, 1, 4)}
    w = Warehouse(fx.good_sources(spark), RunOptions(calendar=short, **TIMES))
    tables = w.tables()
    # Small tables are kept as literal rows: the suite reads each many times.
    return {n: spark.createDataFrame(df.collect(), df.schema) for n, df in tables.items()}


def failed(tables, checks=DECLARED):
    rows = quality.run_suite(tables, checks).collect()
    assert len(rows) == len(checks)
    assert all(r.passed == (r.failures == 0) for r in rows)
    return {r.check_name: r.failures for r in rows if not r.passed}


def test_declared_checks():
    kinds = [c.kind for c in DECLARED]
    assert len(DECLARED) == 58 and len({c.name for c in DECLARED}) == 58
    assert [kinds.count(k) for k in ("unique", "not_null", "relationship")] == [17, 36, 5]


def test_good_tables_pass(good):
    assert failed(good) == {}


def with_null(df, column):
    return df.withColumn(column, F.lit(None).cast(df.schema[column].dataType))


def test_every_not_null_check_can_fail(good):
    """One copy of each table with NULL in every checked column."""
    broken = dict(good)
    for c in DECLARED:
        if c.kind == "not_null":
            broken[c.table] = with_null(broken[c.table], c.column)
    checks = [c for c in DECLARED if c.kind == "not_null"]
    got = failed(broken, checks)
    assert got == {c.name: good[c.table].count() for c in checks}


def test_every_unique_check_can_fail(good):
    broken = {n: df.unionByName(df).unionByName(df) for n, df in good.items()}
    checks = [c for c in DECLARED if c.kind == "unique"]
    got = failed(broken, checks)
    assert got == {c.name: good[c.table].count() for c in checks}


def test_every_relationship_can_fail(good):
    checks = [c for c in DECLARED if c.kind == "relationship"]
    parents = {c.parent for c in checks}
    broken = good | {p: good[p].limit(0) for p in parents}
    got = failed(broken, checks)
    assert got == {c.name: good[c.table].count() for c in checks}


def test_nulls_are_neither_duplicates_nor_orphans(spark, good):
    rows = fx.orders(spark, {"customer_id": None}, {"customer_id": None}, {"customer_id": 9},
                     {"customer_id": 9}, {"customer_id": 1})
    assert [(r.value, r.occurrences) for r in quality.check_unique(rows, ["customer_id"])
            .collect()] == [("9", 2)]
    orphans = quality.check_relationship(rows, "customer_id", good["customers"], "customer_id")
    assert [tuple(r) for r in orphans.collect()] == [(9, 2)]


def test_empty_tables(good):
    empty = {n: df.limit(0) for n, df in good.items()}
    assert failed(empty) == {}


def test_failures_are_stored(spark, good):
    broken = good | {"customers": good["customers"].withColumn("email", F.lit("a@x.com"))}
    check = Check("unique", "customers", "email")
    kept = quality.store_failures(broken, check)
    assert [tuple(r) for r in kept.collect()] == [("email", "a@x.com", 2)]
    assert spark.table("check_failures.unique_customers_email").count() == 1
    quality.store_failures(good, check)
    assert spark.table("check_failures.unique_customers_email").count() == 0


@pytest.mark.parametrize(
    "age, status",
    [(3600, "pass"), (3601, "warn"), (7200, "warn"), (7201, "error"), (None, "error")],
)
def test_freshness(spark, age, status):
    stamp = None if age is None else fx.RUN - dt.timedelta(seconds=age)
    rows = fx.orders(spark, {"updated_at": stamp}, {"updated_at": None})
    got = quality.check_freshness(
        rows, "orders", "updated_at", dt.timedelta(hours=1), dt.timedelta(hours=2), fx.RUN
    ).first()
    assert (got.age_seconds, got.status) == (age, status)


# Verification queries


def test_row_counts_flag_empty_tables(good):
    got = verify.row_counts({"core.a": good["customers"], "core.b": good["orders"].limit(0)})
    assert [tuple(r) for r in got.collect()] == [
        ("core", "a", 2, False), ("core", "b", 0, True)]


def test_not_in_is_null_aware(spark):
    days = spark.createDataFrame([("2024-01-01",), (None,), ("2024-01-02",)], "d string")
    orders = days.selectExpr("cast(d as date) AS order_date")
    calendar = spark.sql("SELECT DATE '2024-01-01' AS full_date")
    got = verify.missing_dates(orders, calendar).collect()
    assert [r.order_date for r in got] == [dt.date(2024, 1, 2)]
    with_null_day = calendar.unionByName(spark.sql("SELECT CAST(NULL AS DATE) AS full_date"))
    assert verify.missing_dates(orders, with_null_day).isEmpty()


def test_recent_orders_with_unknown_customers(spark):
    """The newest orders name no known customer; a repeated product repeats its order."""
    day = dt.datetime(2024, 1, 1)
    rows = [{"order_id": i, "customer_id": 1 if i < 4 else 99,
             "order_date": day + dt.timedelta(days=i)} for i in range(8)]
    got = verify.recent_orders(
        fx.orders(spark, *rows), fx.customers(spark, {"customer_id": 1}),
        fx.products(spark, {"product_id": 1}), k=2,
    ).collect()
    assert [r.order_date.day for r in got] == [4, 3]
    assert got[0].customer_name == "Ann Lee"
    twice = fx.products(spark, {"product_id": 1}, {"product_id": 1})
    got = verify.recent_orders(
        fx.orders(spark, *rows), fx.customers(spark, {"customer_id": 1}), twice, k=3
    ).collect()
    assert [r.order_date.day for r in got] == [4, 4, 3]


def test_undated_orders_come_first(spark):
    rows = [{"order_id": 1}, {"order_id": 2, "order_date": None}]
    got = verify.recent_orders(
        fx.orders(spark, *rows), fx.customers(spark, {"customer_id": 1}),
        fx.products(spark, {"product_id": 1}),
    ).collect()
    assert [r.order_date for r in got] == [None, dt.date(2024, 3, 5)]


def test_orphans_include_the_null_key(spark, good):
    fact = spark.createDataFrame([("x",), (None,), (None,)], "customer_key string")
    got = verify.orphan_keys(fact, good["dim_customers"], "customer_key").collect()
    assert {tuple(r) for r in got} == {("x", 1, 1), (None, 2, 1)}


def test_verification_run(spark, good):
    sources = {n: good[n] for n in ("customers", "products", "orders")}
    got = verify.verify_warehouse(sources, good)
    counts = {r.table_name: r.row_count for r in got["row_counts"].collect()}
    assert counts["fact_orders"] == 3 and counts["orders"] == 3
    assert got["sample_orders"].count() == 3 and got["sample_facts"].count() == 3
    assert got["latest_months"].count() == 1


def test_duplicate_keys_are_counted_in_many_tasks(spark):
    """Adaptive execution merged small shuffled keys into tasks of millions."""
    rows = [(i % 50, i % 7) for i in range(351)] + [(None, 1), (None, 1), (None, None), (900, 1)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(3, "a")
    found = verify.duplicate_keys(df, ["a", "b"])
    assert {(r.a, r.b): r.occurrences for r in found.collect()} == {(0, 0): 2, (None, 1): 2}
    assert found.rdd.getNumPartitions() >= 200
