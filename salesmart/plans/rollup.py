"""Monthly and quarterly figures from states that are kept per range of the fact.

A state of a range and month holds sums, and the orders and customers it saw as bitmaps over
their ids. Sums add up and bitmaps are OR-ed, so exact distinct counts of any months and
ranges come from the states alone, and a change of the fact needs the states of the ranges
it touched to be made anew, no others.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.money import average, from_cents, to_cents
from salesmart.plans.finance import MONTHS

FACT_RANGE = "fact_range"
# Tasks that share the customers of one month and bucket: a month may hold most of the rows.
SPREAD = 16


def _placed(fact: DataFrame, dim_dates: DataFrame, width: int) -> DataFrame:
    """Fact rows with their range and month."""
    days = dim_dates.select("date_key", (F.col("year") * 100 + F.col("month")).alias("month_number"))
    place = F.expr(f"CAST(order_id AS BIGINT) div {int(width)}").alias(FACT_RANGE)
    return fact.join(days, "date_key").select(
        place, "month_number", "order_id", "customer_key", "quantity",
        to_cents(F.col("total_amount")).alias("revenue"), to_cents(F.col("profit_amount")).alias("profit"),
    )


def sum_states(fact: DataFrame, dim_dates: DataFrame, width: int) -> DataFrame:
    """(fact_range, month_number, revenue, profit, priced_rows, quantity), amounts in cents."""
    return _placed(fact, dim_dates, width).groupBy(FACT_RANGE, "month_number").agg(
        F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"),
        F.count("revenue").alias("priced_rows"), F.sum("quantity").alias("quantity"),
    )


def member_states(
    fact: DataFrame, dim_customers: DataFrame, dim_dates: DataFrame, width: int
) -> DataFrame:
    """(fact_range, month_number, kind, bucket, members): the ids seen, as bitmaps.

    A bitmap has the 32,768 ids of its bucket. Customers are known to the fact by key: the
    keys of a range and month are made distinct before the ids are joined to them.

    Ids are shuffled and sorted, not bitmaps: a range has few ids of a bucket, and bitmaps
    of 4 KB are almost empty then. They come in the order of month, kind and bucket, so that
    ``merged_totals`` ORs them as they are made.
    """
    rows = _placed(fact, dim_dates, width)
    place = [FACT_RANGE, "month_number"]
    orders = rows.select(*place, F.lit("order").alias("kind"), F.col("order_id").cast("long").alias("id"))
    keys = rows.where("customer_key IS NOT NULL").select(*place, "customer_key").distinct()
    ids = dim_customers.select("customer_key", F.col("customer_id").cast("long").alias("id"))
    customers = keys.join(ids, "customer_key").select(*place, F.lit("customer").alias("kind"), "id")
    rows = orders.unionByName(customers)
    bucket = ["month_number", "kind", "bucket", "spread"]
    spread = F.when(F.col("kind") == "customer", F.pmod(FACT_RANGE, F.lit(SPREAD))).otherwise(0)
    rows = rows.withColumns({
        "bucket": F.bitmap_bucket_number("id"), "spread": F.coalesce(spread, F.lit(0)).cast("int"),
        "bit": F.bitmap_bit_position("id"),
    }).drop("id")
    made = rows.repartition(*bucket).groupBy(*bucket, FACT_RANGE).agg(
        F.bitmap_construct_agg("bit").alias("members")
    )
    return made.select(*place, "kind", "bucket", "members")


def merged_totals(
    sums: DataFrame, members: DataFrame, dim_dates: DataFrame, kind: tuple[str, str] = MONTHS
) -> DataFrame:
    """What ``finance.period_totals`` gives, from the states of all ranges."""
    period = ["year", *kind]
    number = F.col("year") * 100
    months = dim_dates.select((number + F.col("month")).alias("month_number"), *period).distinct()
    added = sums.join(months, "month_number").groupBy(*period).agg(
        F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"),
        F.sum("priced_rows").alias("priced_rows"), F.sum("quantity").alias("total_quantity_sold"),
    )
    # A bitmap of 4 KB a month, kind and bucket, OR-ed map-side in the order that the states
    # are made in, then one a period.
    by_month = members.groupBy("month_number", "kind", "bucket").agg(
        F.bitmap_or_agg("members").alias("members")
    )
    seen = by_month.join(months, "month_number").groupBy(*period, "kind", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("members")).alias("ids")
    )

    def counted(kind: str):
        return F.sum(F.when(F.col("kind") == kind, F.col("ids")).otherwise(0))

    counts = seen.groupBy(*period).agg(
        counted("order").alias("total_orders"), counted("customer").alias("unique_customers")
    )
    revenue = from_cents(F.col("revenue"))
    return added.join(counts, period).select(
        *period,
        "total_orders",
        "unique_customers",
        revenue.alias("total_revenue"),
        from_cents(F.col("profit")).alias("total_profit"),
        average(revenue, F.col("priced_rows")).alias("avg_order_value"),
        "total_quantity_sold",
    )
