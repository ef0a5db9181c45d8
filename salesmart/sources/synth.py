"""Synthetic customers, products and orders of any volume.

Each row is a function of its id and the seed, so generation is a scan of ids without a
shuffle; only orders are joined, to the customers and products they name.
"""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salesmart.functions.audit import business_date
from salesmart.functions.draws import draw_below, pick
from salesmart.functions.money import PRICE
from salesmart.operators.landing import conform, fill_defaults, truncate_to
from salesmart.schemas import (
    CUSTOMERS, ORDERS, PRODUCTS, WIDTHS, column_defaults,
)

# The domains of the generated columns.
SEGMENTS = ("PREMIUM", "REGULAR", "BASIC", "VIP")
CATEGORIES = {
    "Electronics": ("Smartphones", "Laptops", "Tablets", "Accessories"),
    "Clothing": ("Men", "Women", "Kids", "Accessories"),
    "Home & Garden": ("Furniture", "Decor", "Kitchen", "Garden"),
    "Sports": ("Fitness", "Outdoor", "Team Sports", "Water Sports"),
    "Books": ("Fiction", "Non-Fiction", "Educational", "Children"),
}
BRANDS = ("BrandA", "BrandB", "BrandC", "BrandD", "BrandE")
SUPPLIERS = ("Supplier1", "Supplier2", "Supplier3", "Supplier4")
STATUSES = ("COMPLETED", "SHIPPED", "DELIVERED", "PENDING", "CANCELLED")
PAYMENTS = ("CREDIT_CARD", "DEBIT_CARD", "PAYPAL", "BANK_TRANSFER")
COUNTRY = "USA"
MIN_COST_CENTS, MAX_COST_CENTS = 1000, 50000
MIN_MARKUP_MILLI, MAX_MARKUP_MILLI = 1200, 3000
MAX_QUANTITY = 5
MAX_DISCOUNT_BASIS_POINTS = 2000
TAX_RATE = "0.08"
HISTORY_DAYS = 730

# Words of our own for the free-text columns.
FIRST_NAMES = ("Ada", "Ben", "Cleo", "Dan", "Eve", "Finn", "Gia", "Hugo", "Iris", "Jon")
LAST_NAMES = ("Archer", "Baker", "Cooper", "Dyer", "Fisher", "Glover", "Mason", "Potter")
CITIES = ("Ashford", "Brookside", "Clearwater", "Dunmore", "Eastfield", "Fairview")
STATES = ("Ohio", "Texas", "Maine", "Idaho", "Utah", "Nevada", "Oregon")
STREETS = ("Oak Street", "Mill Road", "Hill Lane", "Lake Avenue")
ADJECTIVES = ("Compact", "Sturdy", "Bright", "Quiet", "Classic", "Smart")
NOUNS = ("Lamp", "Chair", "Bottle", "Speaker", "Jacket", "Notebook", "Racket")

INDEX_BITS = 16


def identities(spark: SparkSession, n: int, column: str) -> DataFrame:
    """Ids 1 to ``n``."""
    return spark.range(1, n + 1).select(F.col("id").alias(column))


def _finished(df: DataFrame, table: str, schema) -> DataFrame:
    rows = truncate_to(fill_defaults(df, column_defaults(table)), WIDTHS[table])
    return conform(rows, schema)


def synth_customers(ids: DataFrame, seed: int, as_of: dt.date | None = None) -> DataFrame:
    """One customer per ``customer_id`` of ``ids``, registered within the last two years."""
    key = F.col("customer_id")
    first = pick(key, seed, 0, FIRST_NAMES)
    last = pick(key, seed, 1, LAST_NAMES)
    rows = ids.select(
        "customer_id",
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(
            F.lower(first), F.lit("."), F.lower(last), F.lit("."), key, F.lit("@example.com")
        ).alias("email"),
        F.concat(
            F.lit("555-"), F.lpad(draw_below(key, seed, 2, 10_000_000).cast("string"), 7, "0")
        ).alias("phone"),
        F.concat(
            draw_below(key, seed, 3, 9999) + 1, F.lit(" "), pick(key, seed, 4, STREETS)
        ).alias("address_line_1"),
        F.lit(None).cast("string").alias("address_line_2"),
        pick(key, seed, 5, CITIES).alias("city"),
        pick(key, seed, 6, STATES).alias("state"),
        F.lit(COUNTRY).alias("country"),
        F.lpad(draw_below(key, seed, 7, 100_000).cast("string"), 5, "0").alias("postal_code"),
        F.date_sub(
            business_date(as_of), draw_below(key, seed, 8, HISTORY_DAYS + 1).cast("int")
        ).alias("registration_date"),
        pick(key, seed, 9, SEGMENTS).alias("customer_segment"),
    )
    return _finished(rows, "customers", CUSTOMERS)


def synth_products(ids: DataFrame, seed: int) -> DataFrame:
    """One product per ``product_id`` of ``ids``, priced at 1.2 to 3 times its cost."""
    key = F.col("product_id")
    category = pick(key, seed, 0, tuple(CATEGORIES))
    subcategories = F.create_map(*[
        F.lit(v) if isinstance(v, str) else F.array(*[F.lit(s) for s in v])
        for item in CATEGORIES.items() for v in item
    ])
    cost = (
        (draw_below(key, seed, 2, MAX_COST_CENTS - MIN_COST_CENTS + 1) + MIN_COST_CENTS)
        .cast("decimal(8,0)") * F.lit("0.01").cast("decimal(2,2)")
    ).cast(PRICE)
    markup = (
        (draw_below(key, seed, 3, MAX_MARKUP_MILLI - MIN_MARKUP_MILLI + 1) + MIN_MARKUP_MILLI)
        .cast("decimal(4,0)") * F.lit("0.001").cast("decimal(3,3)")
    )
    adjective, noun = pick(key, seed, 6, ADJECTIVES), pick(key, seed, 7, NOUNS)
    name = F.concat(adjective, F.lit(" "), noun)
    place = draw_below(key, seed, 1, 4).cast("int") + 1
    rows = ids.select(
        "product_id",
        name.alias("product_name"),
        category.alias("category"),
        F.element_at(F.element_at(subcategories, category), place).alias("subcategory"),
        pick(key, seed, 4, BRANDS).alias("brand"),
        pick(key, seed, 5, SUPPLIERS).alias("supplier"),
        cost.alias("cost_price"),
        F.concat(F.lit("A "), F.lower(name), F.lit(" for every day.")).alias("description"),
        markup.alias("markup"),
    ).withColumn("unit_price", (F.col("cost_price") * F.col("markup")).cast(PRICE))
    return _finished(rows, "products", PRODUCTS)


def dense_index(df: DataFrame, key: str, bits: int = INDEX_BITS) -> DataFrame:
    """Number the rows of ``df`` from 0 in the order of a 64-bit integer ``key``.

    Rows with a NULL key are left out. A row's place is its rank among the keys that share
    all but the last ``bits`` bits, plus the rows of the ranges before it, level by level:
    each level counts ranges of ``bits`` bits within one range of the level above. No
    window has more than 2 ** bits ranges, however the keys are spread.
    """
    rows = df.where(F.col(key).isNotNull()).withColumn(
        "_range0", F.shiftright(F.col(key).cast("long"), bits)
    )
    # Rows per range, from the finest level up; the top level is a single range.
    counts = rows.groupBy("_range0").agg(F.count(F.lit(1)).alias("_rows"))
    levels = [counts]
    top = -(-64 // bits)
    for level in range(1, top + 1):
        above = F.shiftright(f"_range{level - 1}", bits) if level < top else F.lit(0)
        finer = levels[-1].withColumn(f"_range{level}", above)
        levels[-1] = finer
        levels.append(finer.groupBy(f"_range{level}").agg(F.sum("_rows").alias("_rows")))
    before = None
    for level in range(len(levels) - 2, -1, -1):
        above = f"_range{level + 1}"
        earlier = W.partitionBy(above).orderBy(f"_range{level}").rowsBetween(
            W.unboundedPreceding, -1
        )
        placed = levels[level].withColumn(
            "_within", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
        )
        if before is None:
            placed = placed.withColumn("_before", F.col("_within"))
        else:
            placed = placed.join(before, above).withColumn(
                "_before", F.col("_above") + F.col("_within")
            )
        before = placed.select(f"_range{level}", F.col("_before").alias("_above"))
    within = F.row_number().over(W.partitionBy("_range0").orderBy(key))
    return (
        rows.withColumn("_place", within)
        .join(before, "_range0")
        .withColumn("place", F.col("_above") + F.col("_place") - 1)
        .drop("_range0", "_place", "_above")
    )


def synth_orders(
    ids: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    seed: int,
    as_of: dt.date | None = None,
) -> DataFrame:
    """One order per ``order_id`` of ``ids``, for an existing customer and product.

    Dates fall within the two years before ``as_of``; total = gross - discount + tax.
    Customers and products without an id are not ordered by or of; one that is listed
    twice counts once (a product at its lowest price). NULL order ids make no order.
    """
    buyers = customers.select("customer_id").where("customer_id IS NOT NULL").distinct()
    sold = products.where("product_id IS NOT NULL").groupBy("product_id").agg(
        F.min("unit_price").alias("unit_price")
    )
    number = F.nullif(F.count(F.lit(1)), F.lit(0))
    people, goods = (df.agg(number).scalar() for df in (buyers, sold))
    who = dense_index(buyers, "customer_id")
    what = dense_index(sold, "product_id")

    key = F.col("order_id")
    drawn = ids.where("order_id IS NOT NULL").select(
        "order_id",
        draw_below(key, seed, 0, people).alias("customer_place"),
        draw_below(key, seed, 1, goods).alias("product_place"),
    )
    # Every place drawn is taken, unless a side is empty: then the run fails.
    named = drawn.join(
        who.withColumnRenamed("place", "customer_place"), "customer_place", "left"
    ).join(what.withColumnRenamed("place", "product_place"), "product_place", "left")
    start_of_day = business_date(as_of).cast("timestamp_ntz")
    seconds_back = draw_below(key, seed, 3, HISTORY_DAYS * 86_400)
    gross = F.col("unit_price") * F.col("quantity").cast("decimal(1,0)")
    rate = (
        draw_below(key, seed, 4, MAX_DISCOUNT_BASIS_POINTS + 1).cast("decimal(10,0)")
        * F.lit("0.0001").cast("decimal(4,4)")
    ).cast("decimal(5,4)")
    rows = (
        named.withColumn(
            "quantity", (draw_below(key, seed, 2, MAX_QUANTITY) + 1).cast("int")
        )
        .withColumn("gross", gross.cast(PRICE))
        .select(
            "order_id",
            *[
                F.coalesce(c, F.raise_error(F.lit(f"orders need {what}")).cast("long")).alias(c)
                for c, what in (("customer_id", "customers"), ("product_id", "products"))
            ],
            F.timestamp_add("SECOND", -seconds_back, start_of_day).alias("order_date"),
            "quantity",
            "unit_price",
            (F.col("gross") * rate).cast(PRICE).alias("discount_amount"),
            (F.col("gross") * F.lit(TAX_RATE).cast("decimal(2,2)")).cast(PRICE).alias(
                "tax_amount"
            ),
            "gross",
            pick(key, seed, 5, STATUSES).alias("order_status"),
            pick(key, seed, 6, PAYMENTS).alias("payment_method"),
            F.concat(
                draw_below(key, seed, 7, 9999) + 1, F.lit(" "), pick(key, seed, 8, STREETS)
            ).alias("shipping_address"),
        )
        .withColumn(
            "total_amount", F.col("gross") - F.col("discount_amount") + F.col("tax_amount")
        )
    )
    return _finished(rows, "orders", ORDERS)
