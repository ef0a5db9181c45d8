"""Landing operators and table writers, by reading back what they wrote."""

import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import fixtures as fx
from salesmart.operators import landing, verify
from salesmart.operators.landing import live_rows
from salesmart.plans.build import RunOptions, build_all, write_all
from salesmart.schemas import CUSTOMERS, ORDERS, WIDTHS, column_defaults
from salesmart.sources import readers, tables, versions
from salesmart.streaming.incremental import stream_merge, stream_ordered


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_conform_orders_types_and_case(spark):
    text = fx.orders(spark, {}).select([F.col(c).cast("string").alias(c.upper())
                                        for c in reversed(ORDERS.names)])
    got = landing.conform(text, ORDERS)
    assert got.schema.simpleString() == ORDERS.simpleString()
    assert got.first() == fx.orders(spark, {}).first()
    with pytest.raises(PySparkException, match="customer_id"):
        landing.conform(text.drop("CUSTOMER_ID"), ORDERS)


def test_defaults_fill_absent_columns_only(spark):
    rows = fx.orders(spark, {"discount_amount": None}).drop("order_status", "quantity")
    got = landing.fill_defaults(rows, column_defaults("orders")).first()
    assert (got.order_status, got.quantity, got.discount_amount) == ("PENDING", 1, None)
    blank = spark.createDataFrame([(1,)], "customer_id long")
    person = landing.fill_defaults(blank, column_defaults("customers")).first()
    assert (person.country, person.customer_segment, person.is_active) == (
        "USA", "REGULAR", True)
    assert person.created_at == person.updated_at


def test_widths(spark):
    rows = fx.customers(spark, {"customer_id": 1, "first_name": "é" * 60, "phone": None})
    got = landing.truncate_to(rows, WIDTHS["customers"]).first()
    assert (got.first_name, got.phone) == ("é" * 50, None)
    assert landing.fit_widths(rows, WIDTHS["customers"], cut=True).first().first_name == "é" * 50
    with pytest.raises(PySparkException, match="first_name is longer than 50"):
        landing.fit_widths(rows, WIDTHS["customers"]).collect()


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame([("B", 2), ("C", 3)], "v string, k int")
    assert pairs(landing.upsert(target, changes, "k")) == [(1, "a"), (2, "B"), (3, "C")]
    with pytest.raises(PySparkException, match="changed twice"):
        landing.upsert(target, changes.union(changes), "k").collect()


def test_latest_changes(spark):
    rows = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 2), (2, None, 5), (2, "tie", 5), (3, "x", None)],
        "k int, v string, at int",
    )
    got = pairs(landing.latest_changes(rows, "k", "at"))
    assert got == [(1, "new", 2), (2, "tie", 5), (3, "x", None)]


def test_touch_stamps_existing_rows_only(spark):
    target = fx.customers(spark, {"customer_id": 1})
    changes = fx.customers(spark, {"customer_id": 1}, {"customer_id": 2})
    got = landing.touch_updated_at(changes, target, "customer_id", fx.RUN).collect()
    assert {r.customer_id: r.updated_at for r in got} == {1: fx.RUN, 2: fx.STAMP}


def test_full_refresh_switches_folders(spark):
    def location():
        rows = spark.sql("DESCRIBE TABLE EXTENDED s1.t").collect()
        return {r.col_name: r.data_type for r in rows}["Location"]

    first = tables.full_refresh(spark.range(3), "s1.t")
    assert pairs(first) == [(0,), (1,), (2,)] and location().endswith("/a")
    grown = tables.full_refresh(first.union(spark.range(7, 8)), "s1.t")  # reads itself
    assert pairs(grown) == [(0,), (1,), (2,), (7,)] and location().endswith("/b")
    assert pairs(first) == [(0,), (1,), (2,)]
    wider = tables.full_refresh(grown.withColumn("x", F.lit(1)), "s1.t")
    assert wider.columns == ["id", "x"] and spark.table("s1.t").count() == 4


def test_failed_refresh_keeps_the_old_table(spark):
    tables.full_refresh(spark.range(3), "s2.t")
    failing = spark.range(3).select((F.lit(1) / F.col("id")).alias("id"))
    with pytest.raises(PySparkException):
        tables.full_refresh(failing, "s2.t")
    assert spark.table("s2.t").count() == 3


def test_failed_change_of_columns_keeps_the_old_table(spark, monkeypatch):
    tables.full_refresh(spark.range(3), "s4.t")
    real = type(spark).sql

    def failing(self, text, *args, **kwargs):
        if "__next RENAME" in text:
            raise OSError("catalog is gone")
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", failing)
    wider = spark.range(4).withColumn("x", F.lit(1))
    with pytest.raises(OSError):
        tables.full_refresh(wider, "s4.t")
    monkeypatch.undo()
    assert spark.table("s4.t__old").count() == 3
    again = tables.full_refresh(wider, "s4.t")
    assert again.columns == ["id", "x"] and again.count() == 4
    assert not spark.catalog.tableExists("s4.t__old")


def test_folders_unknown_to_the_catalog_are_not_overwritten(spark):
    tables.full_refresh(spark.range(3), "s5.t")
    spark.sql("DROP TABLE s5.t")
    with pytest.raises(PySparkException):
        tables.full_refresh(spark.range(4), "s5.t")


def test_foreign_tables_are_not_replaced(spark):
    tables.ensure_layer(spark, "s3")
    spark.range(1).write.mode("overwrite").saveAsTable("s3.t")
    with pytest.raises(ValueError, match="s3.t"):
        tables.full_refresh(spark.range(2), "s3.t")
    assert spark.table("s3.t").count() == 1


def test_load_all_lands_names_in_capitals(spark):
    sources = fx.good_sources(spark)
    landed = tables.load_all(spark, sources.__getitem__, "land1")
    assert landed["orders"].columns == [c.upper() for c in ORDERS.names]
    assert {n: df.count() for n, df in landed.items()} == {
        "customers": 2, "products": 2, "orders": 3}
    told = verify.verify_landing(landed)
    assert {r.table_name: r.row_count for r in told["row_counts"].collect()} == {
        "customers": 2, "products": 2, "orders": 3}
    assert told["sample_orders"].count() == 3
    bound = tables.bind(spark, "land1", list(sources))
    mart = build_all(bound, RunOptions(as_of=fx.AS_OF))["revenue_analysis"]
    assert [r.total_orders for r in mart.collect()] == [1, 2]


def test_load_stops_at_the_first_failure(spark):
    def read(name):
        if name == "products":
            raise OSError("source is gone")
        return fx.good_sources(spark)[name]

    with pytest.raises(OSError):
        tables.load_all(spark, read, "land2")
    assert not spark.catalog.tableExists("land2.orders")


def test_write_all(spark):
    options = RunOptions(as_of=fx.AS_OF, run_ts=fx.RUN)
    written = write_all(fx.good_sources(spark), options, prefix="wh")
    lazily = build_all(fx.good_sources(spark), options)
    for name, df in lazily.items():
        if name != "dim_dates":
            assert pairs(written[name]) == pairs(df), name
    assert spark.table("wh_core.fact_orders").count() == 3
    assert spark.table("wh_finance.revenue_analysis").count() == 2
    assert spark.table("wh_stg_orders").count() == 3
    for name in ("dim_customers", "dim_products", "dim_dates", "fact_orders", "revenue_analysis"):
        stamps = [c for c in written[name].columns if c.startswith("dw_")]
        assert stamps and all(written[name].where(F.col(c).isNull()).isEmpty() for c in stamps)
    write_all(fx.good_sources(spark), options, prefix="wh")  # and again, over the old ones
    assert spark.table("wh_core.fact_orders").count() == 3


def test_local_folders_are_for_local_runs():
    tables.refuse_local("local[8]", "file:/tmp/warehouse")
    tables.refuse_local("yarn", "hdfs://store/warehouse")
    with pytest.raises(ValueError, match="spark.sql.warehouse.dir"):
        tables.refuse_local("yarn", "file:/tmp/warehouse")


def test_layer_names():
    assert tables.layer_name("core") == "core"
    assert tables.layer_name("core", "public") == "public_core"


def test_jdbc_ranges_grow_with_the_rows():
    got = readers.split_options("orders", "order_id", 1, 2_500_000, 2_500_000, 1_000_000)
    assert got["numPartitions"] == "3"
    assert (got["lowerBound"], got["upperBound"]) == ("1", "2500001")
    assert "partitionColumn" not in readers.split_options("orders", "order_id", None, None, 0, 10)
    # Hashed keys over all 64 bits, negative ones, and more rows than keys.
    hashed = readers.split_options("t", "k", -(1 << 63), (1 << 63) - 1, 5_000_000, 1_000_000)
    assert hashed["numPartitions"] == "5" and hashed["lowerBound"] == str(-(1 << 63))
    assert readers.split_options("t", "k", -9, -5, 10**6, 10)["numPartitions"] == "5"
    assert readers.split_options("t", "k", 1, 9, 0, 10)["numPartitions"] == "1"


def test_read_parquet(spark, tmp_path):
    fx.customers(spark, {"customer_id": 1}).write.parquet(f"{tmp_path}/customers.parquet")
    got = readers.read_parquet(spark, str(tmp_path), "customers")
    assert got.schema.simpleString() == CUSTOMERS.simpleString() and got.count() == 1


# Merging by key range


def ranged_files(spark, table):
    return {r[0] for r in spark.table(table).select("_metadata.file_path").distinct().collect()}


def test_merge_rewrites_touched_ranges_only(spark):
    rows = spark.range(30).selectExpr("id AS order_id", "1 AS product_id", "'old' AS v")
    tables.create_ranged(rows, "r1.t", "order_id", 10)
    before = ranged_files(spark, "r1.t")
    changes = spark.createDataFrame(
        [(25, 1, "new"), (25, 2, "added"), (31, 1, "added")],
        "order_id long, product_id int, v string",
    )
    merged = tables.merge_ranged(changes, "r1.t", ["order_id", "product_id"])
    got = {(r.order_id, r.product_id): r.v for r in merged.collect()}
    assert len(got) == 32 and merged.count() == 32
    assert (got[25, 1], got[25, 2], got[31, 1], got[24, 1]) == ("new", "added", "added", "old")
    untouched = [f for f in before if "key_range=0" in f or "key_range=1" in f]
    assert untouched and set(untouched) <= ranged_files(spark, "r1.t")


def test_merge_needs_a_ranged_table_and_its_key(spark):
    tables.create_ranged(spark.range(5).selectExpr("id", "id AS other"), "r4.t", "id", 10)
    with pytest.raises(ValueError, match="range key id"):
        tables.merge_ranged(spark.table("r4.t").drop("key_range"), "r4.t", ["other"])
    tables.full_refresh(spark.range(3), "r4.plain")
    with pytest.raises(ValueError, match="create_ranged"):
        tables.merge_ranged(spark.range(1), "r4.plain", ["id"])


def test_merge_refuses_null_keys_and_repeats(spark):
    rows = spark.range(20).selectExpr("id AS order_id", "'old' AS v")
    tables.create_ranged(rows, "r5.t", "order_id", 10)
    schema = "order_id long, v string"
    with pytest.raises(ValueError, match="NULL"):
        tables.merge_ranged(spark.createDataFrame([(1, "n"), (None, "n")], schema), "r5.t", ["order_id"])
    with pytest.raises(PySparkException, match="changed twice"):
        tables.merge_ranged(spark.createDataFrame([(1, "n"), (1, "m")], schema), "r5.t", ["order_id"])
    with pytest.raises(ValueError, match="NULL"):
        tables.create_ranged(spark.createDataFrame([(None, "n")], schema), "r5.u", "order_id", 10)
    assert pairs(spark.table("r5.t").select("v").distinct()) == [("old",)]


def test_merge_that_fails_while_switching_can_be_repeated(spark, monkeypatch):
    rows = spark.range(40).selectExpr("id AS order_id", "'old' AS v")
    tables.create_ranged(rows.repartition(4), "r6.t", "order_id", 10)
    assert len(ranged_files(spark, "r6.t")) == 4  # one file per range
    changes = rows.withColumn("v", F.lit("new")).where("order_id % 3 = 0")
    real, calls = type(spark).sql, []

    def failing(self, text, *args, **kwargs):
        if "SET LOCATION" in text:
            calls.append(text)
            if len(calls) == 3:
                raise OSError("catalog is gone")
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(OSError):
        tables.merge_ranged(changes, "r6.t", ["order_id"])
    spark.catalog.refreshTable("r6.t")
    assert spark.table("r6.t").count() == 40
    merged = tables.merge_ranged(changes, "r6.t", ["order_id"])
    assert {r.order_id for r in merged.collect() if r.v == "new"} == set(range(0, 40, 3))
    assert merged.count() == 40 and len(ranged_files(spark, "r6.t")) == 4


def test_merge_removes_rows(spark):
    rows = spark.range(30).selectExpr("id AS order_id", "'old' AS v")
    tables.create_ranged(rows, "r7.t", "order_id", 10)
    removed = spark.range(20, 30).selectExpr("id AS order_id").union(spark.range(3, 4))
    merged = tables.merge_ranged(rows.where("order_id = 3"), "r7.t", ["order_id"], removed)
    assert sorted(r.order_id for r in merged.collect()) == list(range(20))


def test_stream_of_changes(spark, tmp_path):
    rows = spark.range(20).selectExpr("id AS order_id", "'old' AS v", "0 AS at")
    tables.create_ranged(rows, "r2.t", "order_id", 10)
    feed, checkpoint = str(tmp_path / "feed"), str(tmp_path / "checkpoint")
    schema = "order_id long, v string, at int"

    def run():
        stream = spark.readStream.schema(schema).parquet(feed)
        query = stream_merge(stream, "r2.t", ["order_id"], "at", checkpoint)
        query.awaitTermination(120)
        spark.catalog.refreshTable("r2.t")  # written by the stream's own session
        return {r.order_id: r.v for r in spark.table("r2.t").collect()}

    def send(*changes):
        spark.createDataFrame(list(changes), schema).write.mode("append").parquet(feed)

    send((3, "first", 1), (3, "second", 2), (50, "added", 1))
    got = run()
    assert (len(got), got[3], got[50], got[4]) == (21, "second", "added", "old")
    send((4, "later", 3))
    got = run()
    assert (len(got), got[3], got[4]) == (21, "second", "later")
    send((4, "late but older", 2), (3, "third", 3))
    got = run()
    assert (len(got), got[3], got[4]) == (21, "third", "later")
    assert os.listdir(checkpoint)


STATE = "order_id long, line long, v string, at int, is_deleted boolean"
CHANGES = [
    (3, 0, "b", 2, False), (3, 0, None, 3, True), (3, 0, "late", 1, False), (4, 0, "x", 5, False),
    (4, 0, "y", 5, False), (4, 1, None, 5, True), (4, 1, "back", 6, False), (50, 0, "added", 1, False),
    (51, 0, None, 2, True), (51, 0, "late", 1, False), (12, 0, "old and late", 0, False),
]


@pytest.mark.parametrize("name, cuts, seed", [("a", [11], 0), ("b", [4, 8], 1), ("c", [1, 2, 7], 2)])
def test_any_order_and_split_of_changes_gives_one_table(spark, tmp_path, name, cuts, seed):
    table, checkpoint = f"r8.{name}", str(tmp_path / "checkpoint")
    rows = spark.range(20).selectExpr("id AS order_id", "0L AS line", "'old' AS v", "1 AS at", "false AS is_deleted")
    versions.refresh_versioned(rows, table, "order_id", 10)
    changes = random.Random(seed).sample(CHANGES, len(CHANGES))
    for first, last in zip([0, *cuts], [*cuts, len(changes)]):
        batch = spark.createDataFrame(changes[first:last], STATE)
        batch.write.mode("append").parquet(str(tmp_path / "feed"))
        stream = spark.readStream.schema(STATE).parquet(str(tmp_path / "feed"))
        stream_ordered(stream, table, ["order_id", "line"], "at", checkpoint).awaitTermination(120)
    got = live_rows(versions.read_versioned(spark, table), "is_deleted")
    expected = {(i, 0): "old" for i in range(20) if i != 3}
    expected |= {(4, 0): "y", (4, 1): "back", (50, 0): "added"}
    assert {(r.order_id, r.line): r.v for r in got.collect()} == expected
