"""The daily run against full rebuilds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from salesmart.operators import check_states
from salesmart.operators.quality import Check, run_suite
from salesmart.plans import facts, finance, incremental, periods, rollup
from salesmart.plans.build import RunOptions, build_all
from salesmart.sources import versions

OPTIONS = RunOptions(as_of=fx.AS_OF, run_ts=fx.RUN)
LATER = dt.datetime(2024, 6, 1)


def rows(df):
    names = sorted(c for c in df.columns if not c.startswith("dw_"))
    return sorted(map(str, (tuple(r) for r in df.select(*names).collect())))


def sources(spark, *orders, customers=(), products=()):
    people = [{"customer_id": i, "email": f"{i}@x.com", **dict(customers).get(i, {})} for i in range(1, 6)]
    goods = [{"product_id": i, **dict(products).get(i, {})} for i in range(1, 4)]
    return {
        "customers": fx.customers(spark, *people), "products": fx.products(spark, *goods),
        "orders": fx.orders(spark, *orders),
    }


def order(i, **changes):
    day = dt.datetime(2024, 1 + i % 5, 1 + i % 20)
    return {"order_id": i, "customer_id": 1 + i % 5, "product_id": 1 + i % 3, "order_date": day, **changes}


# Order 7 has the same product on two rows: one order key on both.
FIRST = [order(i) for i in range(1, 26)] + [order(7, quantity=5), order(7, product_id=3)]


def check(spark, prefix, landed):
    full = build_all(landed, OPTIONS)
    for name in ("fact_orders", "revenue_analysis", "dim_customers"):
        stored = spark.table(f"{prefix}_{'finance' if name == 'revenue_analysis' else 'core'}.{name}")
        assert rows(stored.drop("key_range")) == rows(full[name]), name
    suite = run_suite(landed | full, incremental.FACT_CHECKS)
    assert rows(incremental.fact_checks(spark, prefix)) == rows(suite)


def test_a_batch_with_one_row_of_a_repeated_key_loses_nothing(spark):
    landed = sources(spark, *FIRST)
    w = build_all(landed, OPTIONS)
    batch = landed["orders"].where("order_id = 7 AND quantity = 5")
    parts = [w[n] for n in ("dim_customers", "dim_products", "dim_dates")]
    merged = facts.merge_fact(w["fact_orders"], landed["orders"], batch, *parts, fx.RUN)
    assert merged.count() == len(FIRST) and rows(merged) == rows(w["fact_orders"])


def test_refresh_equals_a_rebuild(spark):
    incremental.start(sources(spark, *FIRST), OPTIONS, "inc1", width=5)
    check(spark, "inc1", sources(spark, *FIRST))
    before = {r.key_range: r.version for r in versions.live_ranges(spark, "inc1_core.fact_orders").collect()}
    # Order 7 loses a row, 8 is cancelled, 9 moves to another month, 31 comes, 25 is gone.
    second = [o for o in FIRST if o["order_id"] not in (8, 9, 25) and o.get("quantity") != 5]
    second += [order(8, order_status="CANCELLED"), order(9, order_date=dt.datetime(2024, 5, 9)), order(31)]
    second = [{**o, "updated_at": LATER} if o["order_id"] in (7, 8, 9, 31) else o for o in second]
    landed = sources(spark, *second)
    stamped = incremental.changed_since(landed["orders"], fx.STAMP)
    assert sorted(r[0] for r in stamped.collect()) == [7, 8, 9, 31]
    changed = stamped.union(spark.createDataFrame([(25,)], "order_id int"))
    incremental.refresh(landed, changed, OPTIONS, "inc1")
    check(spark, "inc1", landed)
    live = {r.key_range: r.version for r in versions.live_ranges(spark, "inc1_core.fact_orders").collect()}
    assert {r for r in before if live.get(r) == before[r]} == {0, 2, 3, 4}
    assert set(live) - set(before) == {6} and set(before) - set(live) == {5}


def test_changed_dimensions_reach_their_old_orders(spark):
    incremental.start(sources(spark, *FIRST), OPTIONS, "inc2", width=5)
    changes = {"customers": {2: {"is_active": False}}.items(), "products": {3: {"cost_price": 10}}.items()}
    landed = sources(spark, *FIRST, **changes)
    nothing = landed["orders"].limit(0)
    incremental.refresh(landed, nothing, OPTIONS, "inc2")
    check(spark, "inc2", landed)


def test_a_run_that_failed_is_made_good_by_the_next(spark, monkeypatch):
    incremental.start(sources(spark, *FIRST), OPTIONS, "inc3", width=5)
    changes = {"customers": {2: {"is_active": False}}.items()}
    landed = sources(spark, *FIRST[:-1], **changes)

    def failing(*args):
        raise OSError("the store is gone")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "replace_keys", failing)
        with pytest.raises(OSError):
            incremental.refresh(landed, landed["orders"].where("order_id = 7"), OPTIONS, "inc3")
    assert spark.table("inc3_core.changed_orders").count() > 1
    incremental.refresh(landed, landed["orders"].limit(0), OPTIONS, "inc3")
    check(spark, "inc3", landed)
    assert spark.table("inc3_core.changed_orders").count() == 0


def test_states_merge_over_any_ranges(spark):
    w = build_all(sources(spark, *FIRST, order(26, customer_id=99), order(27, order_date=None)), OPTIONS)
    for kind in (finance.MONTHS, finance.QUARTERS):
        full = finance.period_totals(w["fact_orders"], w["dim_dates"], kind)
        for width in (1, 7, 1000):
            sums = rollup.sum_states(w["fact_orders"], w["dim_dates"], width)
            members = rollup.member_states(w["fact_orders"], w["dim_customers"], w["dim_dates"], width)
            merged = rollup.merged_totals(sums, members, w["dim_dates"], kind)
            assert rows(merged) == rows(full)
            assert merged.schema.simpleString() == full.schema.simpleString()
    shares = members.where(F.length("members") != 4096)
    assert shares.isEmpty()


def test_bitmaps_are_neither_shuffled_nor_sorted_before_they_are_merged(spark):
    """Bitmaps of 4 KB that hold a few ids took 6.5 GB of a task that sorted them."""
    w = build_all(sources(spark, *FIRST), OPTIONS)
    sums = rollup.sum_states(w["fact_orders"], w["dim_dates"], 1)
    members = rollup.member_states(w["fact_orders"], w["dim_customers"], w["dim_dates"], 1)
    merged = rollup.merged_totals(sums, members, w["dim_dates"])
    plan = merged._jdf.queryExecution().executedPlan().toString().splitlines()
    made = next(i for i, line in enumerate(plan) if "partial_bitmap_construct_agg" in line)
    ored = max(i for i, line in enumerate(plan) if "partial_bitmap_or_agg" in line and i < made)
    assert not [line for line in plan[ored:made] if "Exchange" in line or "- Sort [" in line]


def test_checks_read_states_only_and_refuse_values_of_many_ranges(spark):
    incremental.start(sources(spark, *FIRST, order(28, customer_id=99)), OPTIONS, "inc4", width=5)
    suite = incremental.fact_checks(spark, "inc4")
    assert {r.check_name: r.failures for r in suite.where("NOT passed").collect()} == {
        "unique_fact_orders_order_key": 1, "not_null_fact_orders_customer_key": 1
    }
    plan = suite._jdf.queryExecution().optimizedPlan().toString()
    assert "state_failures__rows" in plan.lower() and "fact_orders__rows" not in plan.lower()
    ranged = spark.table("inc4_core.fact_orders").withColumn(check_states.STATE_RANGE, F.lit(1))
    with pytest.raises(ValueError, match="several ranges"):
        check_states.failure_states(ranged, [Check("unique", "fact_orders", "customer_key")], ["order_key"])


def test_reports_of_months_read_their_files_only(spark):
    landed = sources(spark, *[order(i, order_date=dt.datetime(2022 + i % 2, 1 + i % 12, 3)) for i in range(60)])
    w = build_all(landed, OPTIONS)
    periods.write_months(w["fact_orders"], w["dim_dates"], "mon1.fact")
    full = finance.revenue_analysis(w["fact_orders"], w["dim_dates"], fx.RUN)
    report = periods.latest_report(spark, "mon1.fact", w["dim_dates"], 5)
    expected = full.orderBy(F.desc("year"), F.desc("month")).limit(5).drop("dw_created_at", "dw_updated_at")
    assert [tuple(r) for r in report.collect()] == [tuple(r) for r in expected.collect()]
    plan = report._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "__rows" in line.lower() or "PartitionFilters" in line]
    assert any("key_range" in line and "IN (" in line for line in scans)
    year = periods.facts_of(spark, "mon1.fact", w["dim_dates"].where("year = 2023"))
    assert year.count() == w["fact_orders"].join(w["dim_dates"].where("year = 2023"), "date_key").count() > 0
    assert "dynamicpruning" in year._jdf.queryExecution().executedPlan().toString()
