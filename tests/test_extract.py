"""Extracts by change and by quantile, and the comparison of source and landing."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from salesmart.operators.reconcile import reconcile
from salesmart.sources import extract

DAY = dt.datetime(2024, 1, 1)


def clustered(rng):
    """Old ids in a dense block, a gap of billions, new ids far apart, one hot id."""
    old = list(range(1, 40_000))
    new = [5_000_000_000 + i * rng.randint(1_000, 90_000) for i in range(20_000)]
    return old + new + [7] * 500


def test_ranges_of_clustered_ids_hold_like_many_rows(spark):
    rng = random.Random(4)
    keys = clustered(rng)
    frame = spark.createDataFrame([(k,) for k in keys], "k long")
    frame.createOrReplaceTempView("keys_of_a_source")
    sql = extract.sample_query("keys_of_a_source", "k", len(keys), 6_000)
    sample = [r.k for r in spark.sql(f"SELECT * FROM {sql}").collect()]
    assert 3_000 < len(sample) < 12_000
    predicates = extract.range_predicates("k", extract.quantile_bounds(sample, 20))
    sizes = [frame.where(p).count() for p in predicates]
    assert len(sizes) == 20 and sum(sizes) == len(keys)
    assert max(sizes) <= 2 * len(keys) / 20


def test_ranges_take_every_row_once(spark):
    frame = spark.createDataFrame([(None,), (1,), (1,), (5,), (-9,)], "k long")
    for sample, splits in (([], 4), ([1], 3), ([1, 1, 1, 5, -9], 3), ([1, 5], 9)):
        predicates = extract.range_predicates("k", extract.quantile_bounds(sample, splits))
        met = [frame.where(p).count() for p in predicates]
        assert sum(met) == 5, (sample, predicates)
        assert all(met[1:]) or len(met) == 1


def test_changes_are_landed_once_and_the_mark_follows(spark, monkeypatch):
    def source(*rows):
        return fx.orders(spark, *[{"order_id": i, "updated_at": DAY + dt.timedelta(days=d), "quantity": q}
                                  for i, d, q in rows])

    def landed():
        return {r.order_id: r.quantity for r in spark.table("ex1.orders").collect()}

    first = [(1, 0, 1), (2, 1, 1), (3, 2, 1)]
    assert extract.land_changes(source(*first), "orders", "order_id", "ex1").count() == 3
    assert extract.stored_mark(spark, "orders", "ex1") == DAY + dt.timedelta(days=2)
    second = [(1, 0, 1), (2, 3, 5), (3, 2, 1), (4, 2, 9)]  # 4 came late, with the mark's own stamp
    with monkeypatch.context() as patch:
        patch.setattr(extract, "_set_mark", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            extract.land_changes(source(*second), "orders", "order_id", "ex1")
    got = extract.land_changes(source(*second), "orders", "order_id", "ex1")
    assert {r.order_id for r in got.collect()} == {2, 3, 4}
    assert landed() == {1: 1, 2: 5, 3: 1, 4: 9}
    assert extract.stored_mark(spark, "orders", "ex1") == DAY + dt.timedelta(days=3)
    assert extract.stored_mark(spark, "customers", "ex1") is None
    assert extract.land_changes(source(*second), "orders", "order_id", "ex1").count() == 1


def test_the_mark_reaches_the_scan(spark, tmp_path):
    fx.orders(spark, {"order_id": 1}).write.parquet(str(tmp_path / "o"))
    rows = extract.changes_since(spark.read.parquet(str(tmp_path / "o")), DAY)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(updated_at" in plan.split("PushedFilters")[1]


def test_one_changed_cell_among_many(spark, settings):
    source = spark.range(60_000).selectExpr(
        "CAST(id AS INT) AS order_id", "id % 7 AS quantity", "IF(id % 5 = 0, NULL, id) AS note"
    )
    landed = source.withColumn("order_id", F.col("order_id").cast("long"))
    assert reconcile(source, landed, "order_id", widths=(10_000, 100)).isEmpty()
    changed = landed.withColumn("note", F.when(F.col("order_id") == 41_237, -1).otherwise(F.col("note")))
    found = reconcile(source, changed, "order_id", widths=(10_000, 100))
    assert [tuple(r) for r in found.collect()] == [(41_237, 1, 1, ["note"])]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "Inner" not in plan


def test_reconciliation_equals_plain_comparison(spark):
    rng = random.Random(8)
    kinds = "k long, a int, b string"
    ours = [(rng.choice([None, *range(40)]), rng.randint(0, 2), rng.choice([None, "x", "y"])) for _ in range(300)]
    theirs = ours[:]
    for _ in range(6):
        theirs[rng.randrange(300)] = (rng.randint(0, 60), rng.randint(0, 2), None)
    theirs += [ours[0], ours[0]]
    # NULLs that change places within a row; two rows that swap a value keep every column's bag.
    ours += [(90, None, "1"), (91, 1, "x"), (91, 2, "y")]
    theirs += [(90, 1, None), (91, 1, "y"), (91, 2, "x")]
    bags = [Counter(), Counter()]
    for bag, rows in zip(bags, (ours, theirs)):
        bag.update(rows)
    expected = {}
    for key in {r[0] for r in ours + theirs}:
        mine, other = (Counter({r: n for r, n in bag.items() if r[0] == key}) for bag in bags)
        if mine != other:
            columns = []
            for i, name in ((1, "a"), (2, "b")):
                cells = [Counter(), Counter()]
                for cell, bag in zip(cells, (mine, other)):
                    for r, n in bag.items():
                        cell[r[i]] += n
                if cells[0] != cells[1]:
                    columns.append(name)
            expected[key] = (sum(mine.values()), sum(other.values()), columns)
    found = reconcile(spark.createDataFrame(ours, kinds), spark.createDataFrame(theirs, kinds), "k", widths=(16, 4))
    assert {r.k: (r.source_rows, r.target_rows, r.differs_in) for r in found.collect()} == expected
    assert expected[91] == (2, 2, [])
