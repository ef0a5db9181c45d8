"""Full-table extracts."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_parquet(
    spark: SparkSession, folder: str, table: str, schema: str | StructType | None = None
) -> DataFrame:
    """The table kept as ``<folder>/<table>.parquet``, of the given or the files' schema."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder}/{table}.parquet")


def key_bounds(spark: SparkSession, table: str, key: str, options: Mapping[str, str]):
    """Smallest and largest ``key`` and row count of a table, worked out by the database."""
    query = (
        f"(SELECT MIN({key}) AS low, MAX({key}) AS high, COUNT(*) AS row_count FROM {table}) bounds"
    )
    return spark.read.format("jdbc").options(**{**options, "dbtable": query}).load().first()


def split_options(
    table: str, key: str, low: int | None, high: int | None, row_count: int,
    rows_per_split: int,
) -> dict[str, str]:
    """Options for a JDBC read of ``table`` in parallel ranges of its integer ``key``.

    The number of ranges follows the rows, not the key values: ids may be sparse.
    """
    options = {"dbtable": table, "fetchsize": "10000"}
    if low is None or high is None:
        return options
    splits = max(1, min(-(-row_count // rows_per_split), high - low + 1))
    return {
        **options,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(splits),
    }


def read_jdbc(
    spark: SparkSession,
    table: str,
    key: str,
    options: Mapping[str, str],
    rows_per_split: int = 1_000_000,
) -> DataFrame:
    """A database table, read by many tasks at once.

    ``options`` are Spark's JDBC options (url, user, password, driver, ...). The number of
    ranges grows with the rows; evenly spread keys make ranges of ``rows_per_split`` rows.
    The executors at hand bound how many are open at a time.
    """
    bounds = key_bounds(spark, table, key, options)
    split = split_options(table, key, bounds["low"], bounds["high"], bounds["row_count"], rows_per_split)
    return spark.read.format("jdbc").options(**{**options, **split}).load()
