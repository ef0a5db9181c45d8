"""The three source tables derived from a TPC-H-like schema.

All amounts are exact, made by whole-number arithmetic in cents; texts are padded and in
mixed case so that staging has something to clean, and some flags, segments, dates,
discounts and taxes are missing.
"""

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from salesmart.operators.landing import conform
from salesmart.schemas import CUSTOMERS, ORDERS, PRODUCTS
from salesmart.sources.readers import read_parquet

# Declared, so that opening a table does not start a job to look at its files.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}

STAMP = "TIMESTAMP_NTZ '2001-01-01 00:00:00'"


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return read_parquet(spark, folder, table, TABLES[table])


def _hundredths(column: str) -> str:
    """A double of two decimals as a whole number of hundredths."""
    return f"CAST(rint({column} * 100) AS BIGINT)"


def _amount(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) * 0.01BD AS DECIMAL(10,2))"


def _share(of: str, rate: str, scale: int) -> str:
    """``of * rate / scale``, half up, for whole numbers not below zero."""
    return f"({of} * {rate} * 2 + {scale}) div {2 * scale}"


# Retail price times 0.1, 1 or 2 by size.
PRICE_CENTS = _share(
    _hundredths("p_retailprice"), "element_at(array(1, 10, 20), p_size % 3 + 1)", 10
)


def adapted_customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    # Provably one row per key, which lets Spark drop the join where no name is asked for.
    places = nation.join(
        region, nation.n_regionkey == region.r_regionkey, "left"
    ).dropDuplicates(["n_nationkey"])
    customers = read_table(spark, folder, "customer")
    rows = customers.join(
        places, customers.c_nationkey == places.n_nationkey, "left"
    ).selectExpr(
        "c_custkey AS customer_id",
        "' customer ' AS first_name",
        "concat(' n', substring(c_name, 10), ' ') AS last_name",
        "concat(' ', replace(c_name, '#', '.'), '@Example.COM ') AS email",
        "c_custkey AS phone",
        "c_custkey AS address_line_1",
        "NULL AS address_line_2",
        "n_name AS city",
        "r_name AS state",
        "n_name AS country",
        "c_custkey AS postal_code",
        "date_add(DATE '1995-01-01', CAST(c_custkey * 37 % 2400 AS INT)) AS registration_date",
        "IF(c_custkey % 7 = 0, NULL, c_mktsegment) AS customer_segment",
        "c_acctbal >= 0 AS is_active",
        f"{STAMP} AS created_at",
        f"{STAMP} AS updated_at",
    )
    return conform(rows, CUSTOMERS)


def adapted_products(spark: SparkSession, folder: str) -> DataFrame:
    cost_tenths = "element_at(array(4, 6, 7, 8), p_size % 4 + 1)"
    rows = read_table(spark, folder, "part").selectExpr(
        "*", f"{PRICE_CENTS} AS cents"
    ).selectExpr(
        "p_partkey AS product_id",
        "concat(' ', p_name, ' ') AS product_name",
        "concat(' ', lower(p_type), ' ') AS category",
        "p_size AS subcategory",
        "concat(' ', lower(p_brand), ' ') AS brand",
        "concat(' Supplier', p_partkey % 4) AS supplier",
        f"{_amount('cents')} AS unit_price",
        f"{_amount(_share('cents', cost_tenths, 10))} AS cost_price",
        "p_name AS description",
        "p_size % 10 <> 0 AS is_active",
        f"{STAMP} AS created_at",
        f"{STAMP} AS updated_at",
    )
    return conform(rows, PRODUCTS)


ORDER_STATUS = """CASE
    WHEN o_orderstatus = 'F' THEN 'DELIVERED'
    WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'COMPLETED'
    WHEN o_orderstatus = 'O' THEN 'SHIPPED'
    WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'CANCELLED'
    WHEN o_orderstatus = 'P' THEN 'PENDING' END"""
PAYMENT_METHOD = """element_at(
    array('CREDIT_CARD', 'DEBIT_CARD', 'PAYPAL', 'BANK_TRANSFER'), l_linenumber % 4 + 1)"""


def adapted_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One order per line item. Order ids therefore repeat, unlike in a real source."""
    lines = read_table(spark, folder, "lineitem")
    orders = read_table(spark, folder, "orders")
    prices = read_table(spark, folder, "part").selectExpr(
        "p_partkey", f"{PRICE_CENTS} AS cents"
    ).selectExpr("*", f"{_amount('cents')} AS unit_price")
    lined = lines.join(prices, lines.l_partkey == prices.p_partkey).join(
        orders, lines.l_orderkey == orders.o_orderkey
    )
    priced = lined.selectExpr("*", "CAST(l_quantity AS INT) * cents AS gross").selectExpr(
        "*",
        f"{_share('gross', _hundredths('l_discount'), 100)} AS discount",
        f"{_share('gross', _hundredths('l_tax'), 100)} AS tax",
    )
    rows = priced.selectExpr(
        "l_orderkey AS order_id",
        "o_custkey AS customer_id",
        "l_partkey AS product_id",
        "IF(o_orderkey % 97 = 0, NULL, o_orderdate) AS order_date",
        "l_quantity AS quantity",
        "unit_price",
        f"{_amount('nullif(discount, 0)')} AS discount_amount",
        f"{_amount('nullif(tax, 0)')} AS tax_amount",
        f"{_amount('(gross - discount + tax)')} AS total_amount",
        f"{ORDER_STATUS} AS order_status",
        f"{PAYMENT_METHOD} AS payment_method",
        "o_custkey AS shipping_address",
        "o_orderdate AS created_at",
        "o_orderdate AS updated_at",
    )
    return conform(rows, ORDERS)


class Adapted(Mapping):
    """``customers``, ``products`` and ``orders`` over a folder, made when asked for."""

    _makers = {
        "customers": adapted_customers,
        "products": adapted_products,
        "orders": adapted_orders,
    }

    def __init__(self, spark: SparkSession, folder: str):
        self._where = spark, folder

    def __getitem__(self, name: str) -> DataFrame:
        return self._makers[name](*self._where)

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def adapt(spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    """The three source tables over the Parquet files of ``folder``."""
    return Adapted(spark, folder)
