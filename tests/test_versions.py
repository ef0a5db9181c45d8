"""Tables kept in versions of ranges: what a change reads, writes and shows."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salesmart.sources import tables, versions


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def files(spark, table):
    rows = spark.table(f"{table}__rows").select("_metadata.file_path", "version", "key_range")
    return {tuple(r) for r in rows.distinct().collect()}


@pytest.fixture
def orders(spark):
    return spark.range(40).selectExpr("id AS order_id", "id % 2 AS line", "'old' AS v").union(
        spark.sql("SELECT 5L, 9L, 'old'")
    )


def test_replace_touches_ranges_of_changed_keys_only(spark, orders):
    versions.refresh_versioned(orders, "v1.t", "order_id", 10)
    before = files(spark, "v1.t")
    changed = spark.createDataFrame([(5,), (13,), (99,)], "order_id long")
    rows = spark.createDataFrame([(5, 1, "new"), (99, 1, "new")], "order_id long, line long, v string")
    got = versions.replace_keys(rows, "v1.t", changed)
    # Both rows of key 5 left, key 13 is deleted, key 99 has come.
    expected = [(i, i % 2, "old") for i in range(40) if i not in (5, 13)] + [(5, 1, "new"), (99, 1, "new")]
    assert values(got, "order_id", "line", "v") == sorted(expected)
    added = files(spark, "v1.t") - before
    assert {r for _, _, r in added} == {0, 1, 9} and before <= files(spark, "v1.t")
    live = values(versions.live_ranges(spark, "v1.t"), "key_range", "version", "n_rows")
    assert [(r, n) for r, _, n in live] == [(0, 10), (1, 9), (2, 10), (3, 10), (9, 1)]
    assert live[0][1] == live[1][1] == live[4][1] > live[2][1] == live[3][1]


def test_readers_see_a_change_as_a_whole(spark, orders, monkeypatch):
    versions.refresh_versioned(orders, "v2.t", "order_id", 10)
    before = values(spark.table("v2.t"), "order_id", "line", "v")
    changed = orders.select("order_id").where("order_id % 7 = 0")
    rows = orders.where("order_id % 7 = 0").withColumn("v", F.lit("new"))
    begun = spark.table("v2.t").select("order_id", "line", "v")

    def failing(df, table):
        raise OSError("catalog is gone")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "full_refresh", failing)
        with pytest.raises(OSError):
            versions.replace_keys(rows, "v2.t", changed)
    assert values(spark.table("v2.t"), "order_id", "line", "v") == before
    got = versions.replace_keys(rows, "v2.t", changed)  # repeated after the failure
    assert {r.order_id for r in got.collect() if r.v == "new"} == set(range(0, 40, 7))
    assert got.count() == 41
    assert values(begun, "order_id", "line", "v") == before  # a reader that had begun
    assert len({v for _, v, _ in files(spark, "v2.t")}) == 3  # that of the failed run as well
    assert versions.drop_superseded(spark, "v2.t") == 8
    assert len({v for _, v, _ in files(spark, "v2.t")}) == 1
    assert spark.table("v2.t").count() == 41


def test_refresh_replaces_the_whole(spark, orders):
    versions.refresh_versioned(orders, "v3.t", "order_id", 10)
    got = versions.refresh_versioned(orders.where("order_id < 15"), "v3.t", "order_id", 10)
    assert got.count() == 16 and got.columns == orders.columns
    assert versions.drop_superseded(spark, "v3.t") == 4
    with pytest.raises(ValueError, match="another key or width"):
        versions.refresh_versioned(orders, "v3.t", "order_id", 20)


def test_keys_that_fit_nowhere_are_refused(spark, orders):
    versions.refresh_versioned(orders, "v4.t", "order_id", 10)
    one = orders.where("order_id = 3")
    with pytest.raises(ValueError, match="not among the changed"):
        versions.replace_keys(one, "v4.t", orders.where("order_id = 4"))
    null = orders.limit(1).withColumn("order_id", F.lit(None).cast("long"))
    with pytest.raises(PySparkException, match="belongs to no range"):
        versions.replace_keys(null.limit(0), "v4.t", null)
    tables.full_refresh(orders, "v4.plain")
    with pytest.raises(ValueError, match="not kept in versions"):
        versions.replace_keys(one, "v4.plain", one)
    assert spark.table("v4.t").count() == 41


def test_live_versions_prune_the_scan(spark, orders):
    versions.refresh_versioned(orders, "v5.t", "order_id", 10)
    versions.replace_keys(orders.where("order_id = 3"), "v5.t", orders.where("order_id = 3"))
    plan = spark.table("v5.t")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
