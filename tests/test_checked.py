"""A run that shows nothing before its checks have passed."""

import pytest

import fixtures as fx
from salesmart.operators.quality import DECLARED, Check, rejected_rows
from salesmart.plans.build import RunOptions
from salesmart.plans.checked import ChecksFailed, run_checked

OPTIONS = RunOptions(as_of=fx.AS_OF, run_ts=fx.RUN)


def run(spark, sources, prefix, **more):
    return run_checked(
        spark, sources.__getitem__, OPTIONS, prefix, f"{prefix}_landing", failures=f"{prefix}_failures", **more
    )


def count(spark, table):
    return spark.table(table).count()


def broken(spark):
    """Two customers of one address, an order without a product row."""
    sources = fx.good_sources(spark)
    people = ({"customer_id": i, "email": "same@x.com"} for i in (1, 2))
    more = fx.orders(spark, {"order_id": 4, "product_id": 77})
    return sources | {"customers": fx.customers(spark, *people), "orders": sources["orders"].union(more)}


def test_a_broken_batch_leaves_the_old_version(spark):
    found = run(spark, fx.good_sources(spark), "ck1")
    assert {r.table_name: r.row_count for r in found["row_counts"].collect()}["fact_orders"] == 3
    assert found["landing_row_counts"].count() == 3 and found["latest_months"].count() == 2
    with pytest.raises(ChecksFailed) as failure:
        run(spark, broken(spark), "ck1")
    assert failure.value.failures == {
        "unique_customers_email": 1, "unique_stg_customers_email": 1, "unique_dim_customers_email": 1,
        "relationship_orders_product_id": 1, "not_null_fact_orders_product_key": 1,
    }
    # The old version is what readers see, in every layer.
    assert count(spark, "ck1_landing.orders") == 3 and count(spark, "ck1_core.fact_orders") == 3
    assert spark.table("ck1_landing.customers").select("email").distinct().count() == 2
    # Values, rows and refused tables are kept.
    values = spark.table("ck1_failures.unique_customers_email").collect()
    assert [(r.value, r.occurrences) for r in values] == [("same@x.com", 2)]
    assert count(spark, "ck1_failures.unique_customers_email__rows") == 2
    orphans = spark.table("ck1_failures.relationship_orders_product_id__rows").collect()
    assert [(r.order_id, r.product_id) for r in orphans] == [(4, 77)]
    assert count(spark, "ck1_core.fact_orders__rejected") == 4
    # A mended batch goes through.
    mended = fx.good_sources(spark)
    mended["orders"] = mended["orders"].union(fx.orders(spark, {"order_id": 5}))
    run(spark, mended, "ck1")
    assert count(spark, "ck1_core.fact_orders") == 4 and count(spark, "ck1_stg_orders") == 4
    assert not spark.catalog.tableExists("ck1_core.fact_orders__rejected")


def test_a_first_batch_may_be_refused_or_allowed(spark):
    with pytest.raises(ChecksFailed, match="unique_customers_email: 1"):
        run(spark, broken(spark), "ck2")
    assert not spark.catalog.tableExists("ck2_core.fact_orders")
    names = [c.name for c in DECLARED]
    run(spark, broken(spark), "ck2", allowed=dict.fromkeys(names, 1))
    assert count(spark, "ck2_core.fact_orders") == 4
    # Checks may be chosen.
    few = [c for c in DECLARED if c.kind == "not_null" and c.table == "orders"]
    run(spark, broken(spark), "ck2", checks=few)


def test_rejected_rows_are_whole_rows(spark):
    tables = broken(spark)
    rows = rejected_rows(tables, Check("relationship", "orders", "product_id", "products", "product_id"))
    assert rows.columns == tables["orders"].columns and rows.count() == 1
    assert rejected_rows(tables, Check("unique", "orders", "customer_id")).count() == 3
    assert rejected_rows(tables, Check("not_null", "orders", "discount_amount")).count() == 4
