"""Verification queries over sources, core tables and the mart."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.session import MIN_PARTITIONS

SAMPLE = (
    "first_name", "last_name", "customer_segment", "product_name", "category",
    "total_amount", "order_date",
)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(layer, table_name, row_count, is_empty)`` for tables named ``<layer>.<table>``."""
    counts = []
    for name, df in tables.items():
        layer, table = name.split(".")
        counted = df.agg(F.count(F.lit(1)).alias("row_count"))
        counts.append(
            counted.select(
                F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count"
            )
        )
    return reduce(DataFrame.unionByName, counts).withColumn(
        "is_empty", F.col("row_count") == 0
    )


def star_sample(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Every order with its customer and product, all columns as text."""
    return _with_names(orders, customers, products).select(
        *[F.col(c).cast("string").alias(c) for c in SAMPLE]
    )


def _with_names(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    rows = orders.select("order_id", "customer_id", "product_id", "order_date", "total_amount")
    who = customers.select("customer_id", "first_name", "last_name", "customer_segment")
    what = products.select("product_id", "product_name", "category")
    return rows.join(who, "customer_id").join(what, "product_id")


def _first_named(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    order: Sequence[Column],
    k: int,
) -> DataFrame:
    """The first ``k`` orders, in ``order``, that have both a customer and a product.

    Which orders have both takes their ids only; the names are joined to the ``k`` rows
    that are left. A repeated customer or product repeats its orders, as any join would,
    so the names are cut to ``k`` rows once more.
    """
    rows = orders.select("order_id", "customer_id", "product_id", "order_date", "total_amount")
    for side, key in ((customers, "customer_id"), (products, "product_id")):
        rows = rows.join(side.select(key), key, "left_semi")
    first = rows.orderBy(*order).limit(k)
    return _with_names(first, customers, products).orderBy(*order).limit(k)


def recent_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    k: int = 5,
) -> DataFrame:
    """The ``k`` latest orders with customer and product name.

    As in the source database, undated orders sort as the latest; order and product id
    settle ties.
    """
    order = [
        F.desc_nulls_first("order_date"), F.desc("order_id"), F.desc("product_id"),
        F.desc("total_amount"),
    ]
    return _first_named(orders, customers, products, order, k).select(
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
        "product_name",
        "total_amount",
        F.to_date("order_date").alias("order_date"),
    )


def sample_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    k: int = 5,
) -> DataFrame:
    """Any ``k`` orders with customer and product: those of the lowest ids."""
    order = [F.asc("order_id"), F.asc("product_id"), F.asc("total_amount"), F.asc("order_date")]
    return _first_named(orders, customers, products, order, k).select(*SAMPLE)


def sample_rows(
    df: DataFrame, columns: Sequence[str], k: int = 5, order: Sequence[str] = ()
) -> DataFrame:
    """``k`` rows of ``df``: any, or the first in ``order``."""
    rows = df.select(*columns)
    return (rows.orderBy(*order) if order else rows).limit(k)


def latest_months(mart: DataFrame, k: int = 5) -> DataFrame:
    """The mart's last ``k`` months, latest first."""
    return mart.orderBy(F.desc("year"), F.desc("month")).limit(k).select(
        "year", "month", "month_name", "total_revenue", "total_orders", "avg_order_value"
    )


def missing_dates(orders: DataFrame, dim_dates: DataFrame) -> DataFrame:
    """Distinct order days the calendar lacks.

    A NULL-aware NOT IN, as in SQL: unknown days are not reported, and a NULL in the
    calendar would hide every other. Spark broadcasts the calendar for it: one row per
    day, whatever the volume of orders.
    """
    days = orders.select("order_date").distinct()
    return days.where(~F.col("order_date").isin(dim_dates.select("full_date")))


def date_coverage(orders: DataFrame, dim_dates: DataFrame) -> DataFrame:
    """First and last day of the orders and of the calendar."""
    def span(df: DataFrame, name: str, column: str) -> DataFrame:
        day = F.to_date(column)
        return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")).select(
            F.lit(name).alias("table_name"), "first_day", "last_day"
        )

    return span(orders, "orders", "order_date").unionByName(
        span(dim_dates, "dim_dates", "full_date")
    )


def orphan_keys(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """``(key, fact_records, missing_dim)``: fact keys without a dimension row, and NULL.

    Facts are counted per key before the join, so no key is joined more than once.
    """
    counted = fact.groupBy(key).agg(F.count(F.lit(1)).alias("fact_records"))
    return counted.join(dimension.select(key), key, "left_anti").withColumn(
        "missing_dim", F.lit(1)
    )


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``(key..., occurrences)``: keys on more than one row.

    Almost every key is another, so counting map-side saves nothing: it held all keys of a
    large task of the step before in memory, twice. The keys alone are dealt to as many
    tasks as the session has shuffle partitions, ``MIN_PARTITIONS`` at least, which adaptive
    execution does not merge. Rows of one key are counted one by one, however many.
    """
    keys = [key] if isinstance(key, str) else list(key)
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select(*keys).repartition(max(width, MIN_PARTITIONS), *keys)
    return (
        dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")
    )


def verify_landing(landed: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """After a load: row counts of the landing tables, and a joined sample of them."""
    tables = {n: df.toDF(*[c.lower() for c in df.columns]) for n, df in landed.items()}
    return {
        "row_counts": row_counts({f"landing.{n}": df for n, df in tables.items()}),
        "sample_orders": sample_orders(**tables),
    }


def verify_warehouse(
    sources: Mapping[str, DataFrame], tables: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """The whole verification run: counts of every layer, samples and latest months."""
    layers = {f"source.{n}": df for n, df in sources.items()}
    for name in ("dim_customers", "dim_products", "dim_dates", "fact_orders"):
        layers[f"core.{name}"] = tables[name]
    layers["finance.revenue_analysis"] = tables["revenue_analysis"]
    fact_columns = ["order_key", "customer_key", "product_key", "quantity", "total_amount"]
    return {
        "row_counts": row_counts(layers),
        "sample_orders": sample_orders(**sources),
        "sample_facts": sample_rows(tables["fact_orders"], fact_columns),
        "latest_months": latest_months(tables["revenue_analysis"]),
    }
