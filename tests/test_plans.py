"""What Spark makes of the queries: scans, shuffles, broadcasts and skew."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from salesmart.operators import landing, quality, verify
from salesmart.operators.joins import lookup_join
from salesmart.plans.build import RunOptions, Warehouse
from salesmart.plans.dimensions import dim_dates
from salesmart.operators.calendar import date_spine
from salesmart.plans.facts import fact_orders
from salesmart.plans.finance import customer_value, margin_by_tier
from salesmart.session import shuffle_partitions

OPTIONS = RunOptions(as_of=fx.AS_OF, run_ts=fx.RUN)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ran(df):
    """The plan after it has run, as adaptive execution left it."""
    df.collect()
    return plan(df)


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("landed"))
    for name, df in fx.good_sources(spark).items():
        df.write.parquet(f"{folder}/{name}")
    return {n: spark.read.parquet(f"{folder}/{n}") for n in ("customers", "products", "orders")}


@pytest.fixture
def no_broadcast(settings):
    """As on a cluster where no dimension is small."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )


def scan_of(text, column):
    return next(line for line in text.splitlines() if "FileScan" in line and column in line)


def test_filters_and_columns_reach_the_scan(landed):
    w = Warehouse(landed, OPTIONS)
    text = plan(w.stg_orders.groupBy("customer_id").agg(F.sum("total_amount")))
    scan = scan_of(text, "order_status")
    assert re.search(r"PushedFilters: \[In\(order_status, ?\[", scan)
    assert "shipping_address" not in scan and "payment_method" not in scan
    assert "EqualTo(is_active,true)" in plan(w.stg_customers)
    assert "Exchange" not in plan(w.stg_orders)


def test_small_dimensions_are_broadcast(landed):
    text = plan(Warehouse(landed, OPTIONS).fact_orders)
    assert text.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in text
    assert "hashpartitioning" not in text


def test_no_surrogate_key_crosses_a_shuffle(landed, no_broadcast):
    w = Warehouse(landed, OPTIONS)
    text = plan(w.fact_orders)
    assert text.count("SortMergeJoin") == 3
    # Order, customer and product keys are made above the joins, in one place.
    assert text.count("AS order_key") == text.count("AS customer_key") == 1
    assert text.index("AS order_key") < text.index("SortMergeJoin")


def test_lookups_carry_ids_and_cost_only(landed, no_broadcast):
    text = plan(Warehouse(landed, OPTIONS).fact_orders)
    customers = scan_of(text, "is_active")
    assert "ReadSchema: struct<customer_id:bigint,is_active:boolean>" in customers


def test_mart_has_one_window_and_no_extra_sort_exchange(landed):
    text = plan(Warehouse(landed, OPTIONS).revenue_analysis)
    assert len(re.findall(r"\bWindow \[", text)) == 1
    assert text.count("Exchange SinglePartition") == 1
    assert "rangepartitioning" not in text
    assert text.count("Expand") == 1


def test_facts_are_reduced_before_dimension_joins(landed, no_broadcast):
    w = Warehouse(landed, OPTIONS)
    fact = w.fact_orders
    for report, dim in ((customer_value, w.dim_customers), (margin_by_tier, w.dim_products)):
        text = plan(report(fact, dim))
        top = text.index("SortMergeJoin")
        assert "HashAggregate" in text[top:]


def test_suite_scans_each_table_once(landed):
    w = Warehouse(landed, OPTIONS)
    checks = [c for c in quality.DECLARED if c.table == "customers"]
    text = plan(quality.run_suite({"customers": w.customers}, checks))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    # Ten tables, and the two sources and three dimensions that are referred to.
    tables = {n: landed[t] for n, t in zip(
        ("customers", "products", "orders"), ("customers", "products", "orders"))}
    mine = [c for c in quality.DECLARED if c.table in tables]
    assert plan(quality.run_suite(tables, mine)).count("FileScan") == 5


def test_top_orders_are_one_lazy_plan(spark, landed):
    """Building starts no job; names are joined to the few rows that are left."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("top orders", "built only")
    df = verify.recent_orders(landed["orders"], landed["customers"], landed["products"])
    assert not tracker.getJobIdsForGroup("top orders")
    text = plan(df)
    assert text.count("TakeOrderedAndProject") == 2
    names = text.index("TakeOrderedAndProject", text.index("TakeOrderedAndProject") + 1)
    assert text[names:].count("LeftSemi") == 2 and "LeftSemi" not in text[:names]


def test_touch_reads_matching_keys_only(landed):
    """The target meets the changes before its keys are made distinct."""
    changes = landed["customers"].where("customer_id < 5")
    text = plan(landing.touch_updated_at(changes, landed["customers"], "customer_id"))
    assert "LeftSemi" in text and text.index("HashAggregate") < text.index("LeftSemi")


def test_calendar_query_reads_one_table(spark):
    from salesmart import registry

    for name in ("date_spine", "dim_dates"):
        text = plan(registry.QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert text.count("FileScan") == 1 and "o_orderdate" in text and "lineitem" not in text


def test_top_k_without_full_sort(landed):
    w = Warehouse(landed, OPTIONS)
    assert "TakeOrderedAndProject" in plan(verify.latest_months(w.revenue_analysis))


# Skew ----------------------------------------------------------------------------------

HOT = 7


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Orders of which a third name one customer and product, and a third name none."""
    n = 60_000
    third = F.col("id") % 3
    ids = spark.range(0, n, 1, 16).select(
        F.col("id").alias("order_id"),
        F.when(third == 0, HOT).when(third == 1, F.col("id") % 900).cast("long")
        .alias("customer_id"),
        F.when(third == 0, HOT).when(third == 1, F.col("id") % 300).cast("long")
        .alias("product_id"),
    )
    template = fx.orders(spark, {}).drop("order_id", "customer_id", "product_id")
    rows = ids.crossJoin(F.broadcast(template)).withColumn(
        "shipping_address", F.sha2(F.col("order_id").cast("string"), 512)
    )
    folder = str(tmp_path_factory.mktemp("skewed"))
    rows.write.parquet(f"{folder}/orders")
    people = spark.range(900).selectExpr("id AS customer_id")
    goods = spark.range(300).selectExpr("id AS product_id")
    who = fx.customers(spark, {}).drop("customer_id")
    what = fx.products(spark, {}).drop("product_id")
    sources = {
        "orders": spark.read.parquet(f"{folder}/orders"),
        "customers": people.crossJoin(F.broadcast(who)),
        "products": goods.crossJoin(F.broadcast(what)),
    }
    return Warehouse(sources, OPTIONS)


TINY_SKEW = {
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "5kb",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "5kb",
}


def digest(df):
    keys = [c for c in df.columns if not c.startswith("dw_")]
    return df.agg(F.count("*"), F.sum(F.xxhash64(*keys).cast("decimal(38,0)"))).first()


def test_hot_and_missing_keys_are_split(skewed, settings, no_broadcast):
    settings(**TINY_SKEW)
    fact = skewed.fact_orders
    assert fact.groupBy().agg(F.count("*")).first()[0] == 60_000
    text = ran(fact.select("customer_key", "product_key", "profit_amount"))
    assert "SortMergeJoin(skew=true)" in text


def test_salted_joins_give_the_same_fact(skewed, no_broadcast):
    w = skewed
    plain = digest(w.fact_orders)
    salted = fact_orders(
        w.stg_orders, w.dim_customers, w.dim_products, w.dim_dates, fx.RUN, salts=8
    )
    assert digest(salted) == plain


def test_salt_spreads_the_hot_key(skewed, spark):
    rows = skewed.stg_orders.select("order_id", "customer_id")
    people = skewed.dim_customers.select("customer_id", F.lit(1).alias("known"))
    joined = lookup_join(rows, people, "customer_id", salts=8, spread_by="order_id")
    assert joined.columns == ["customer_id", "order_id", "known"]
    assert joined.count() == 60_000
    assert joined.where("known is null").count() == 20_000


def test_skewed_reports(skewed, no_broadcast):
    got = customer_value(skewed.fact_orders, skewed.dim_customers)
    hot = got.orderBy(F.desc("orders")).first()
    assert got.count() == 300 and hot.orders >= 20_000
    orphans = quality.check_relationship(
        skewed.orders, "customer_id", skewed.customers.where(f"customer_id <> {HOT}"),
        "customer_id",
    ).collect()
    assert [r.value for r in orphans] == [HOT] and orphans[0].failures >= 20_000


def test_calendar_is_one_small_task(spark):
    calendar = dim_dates(date_spine(spark))
    assert calendar.rdd.getNumPartitions() == 1
    keys = calendar.select("full_date", "date_key")._jdf.queryExecution().optimizedPlan()
    assert int(str(keys.stats().sizeInBytes())) < 10 * 1024 * 1024
    assert date_spine(spark, dt.date(1000, 1, 1), dt.date(9000, 1, 1)).rdd.getNumPartitions() == 3


def test_partitions_grow_with_the_shuffle():
    assert shuffle_partitions(0) == shuffle_partitions(10**9) == 200
    assert shuffle_partitions(10 * 10**12) == 18_627
