"""Extracts of what changed, and parallel extracts of unevenly spread keys."""

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.landing import latest_changes, upsert
from salesmart.sources.tables import full_refresh

MARKS = "high_water"
SAMPLE_KEYS = 100_000


# By key quantiles --------------------------------------------------------------------------


def sample_query(table: str, key: str, row_count: int, most: int = SAMPLE_KEYS) -> str:
    """SQL for the database: about ``most`` keys, chosen by a hash that clusters do not follow."""
    share = max(1, row_count // most)
    return f"(SELECT {key} AS k FROM {table} WHERE MOD(MOD({key}, 2147483647) * 48271, {share}) = 0) keys_sampled"


def quantile_bounds(sample: Sequence[int], splits: int) -> list[int]:
    """Keys that cut the sampled ones into ``splits`` parts of like size; distinct, ascending."""
    ordered = sorted(sample)
    places = (len(ordered) * i // splits for i in range(1, splits))
    return sorted({ordered[p] for p in places} - set(ordered[:1])) if ordered else []


def range_predicates(key: str, bounds: Sequence[int]) -> list[str]:
    """Conditions of which every row meets exactly one; rows without a key meet the first."""
    if not bounds:
        return ["1 = 1"]
    inner = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(bounds, bounds[1:])]
    return [f"{key} < {bounds[0]} OR {key} IS NULL", *inner, f"{key} >= {bounds[-1]}"]


def read_jdbc_by_quantile(
    spark: SparkSession, table: str, key: str, options: Mapping[str, str], rows_per_split: int = 1_000_000
) -> DataFrame:
    """A database table in ranges of like many rows, however its ids are spread.

    The cuts come from a bounded sample of the keys; each range is one task's query.
    """
    def query(sql: str) -> DataFrame:
        return spark.read.format("jdbc").options(**{**options, "dbtable": sql}).load()

    rows = query(f"(SELECT COUNT(*) AS n FROM {table}) counted").first()[0]
    splits = max(1, -(-int(rows) // rows_per_split))
    sample = [r[0] for r in query(sample_query(table, key, int(rows))).collect() if r[0] is not None]
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    predicates = range_predicates(key, quantile_bounds(sample, splits))
    return spark.read.jdbc(options["url"], table, predicates=predicates, properties={**rest, "fetchsize": "10000"})


# By change ---------------------------------------------------------------------------------


def stored_mark(spark: SparkSession, table: str, schema: str = "landing") -> dt.datetime | None:
    """The newest change stamp that has been landed for a table."""
    if not spark.catalog.tableExists(f"{schema}.{MARKS}"):
        return None
    row = spark.table(f"{schema}.{MARKS}").where(F.col("table_name") == table).first()
    return row and row["mark"]


def _set_mark(spark: SparkSession, table: str, mark: dt.datetime, schema: str) -> None:
    row = spark.createDataFrame([(table, mark)], "table_name string, mark timestamp_ntz")
    name = f"{schema}.{MARKS}"
    known = spark.catalog.tableExists(name)
    full_refresh(upsert(spark.table(name), row, "table_name") if known else row, name)


def changes_since(rows: DataFrame, mark: dt.datetime | None, stamp: str = "updated_at") -> DataFrame:
    """Rows stamped at or after the mark (equal stamps may have come later), and unstamped ones."""
    if mark is None:
        return rows
    return rows.where((F.col(stamp) >= F.lit(mark).cast("timestamp_ntz")) | F.col(stamp).isNull())


def land_changes(
    source: DataFrame, table: str, key: str | Sequence[str], schema: str = "landing", stamp: str = "updated_at"
) -> DataFrame:
    """Land what changed since the stored mark; the rows extracted.

    The condition on ``stamp`` reaches the scan, or the database. Rows replace those of equal
    key; the mark moves when they are landed, so a run that fails in between extracts the
    same rows again, which changes nothing. A source says nothing of deleted rows.
    """
    spark, name = source.sparkSession, f"{schema}.{table}"
    mark = stored_mark(spark, table, schema)
    changes = latest_changes(changes_since(source, mark, stamp), key, stamp)
    changes = full_refresh(changes, f"{schema}.{table}__changes")
    if spark.catalog.tableExists(name):
        full_refresh(upsert(spark.table(name), changes, key), name)
    else:
        full_refresh(changes, name)
    newest = changes.agg(F.max(stamp)).first()[0]
    if newest is not None and (mark is None or newest > mark):
        _set_mark(spark, table, newest, schema)
    return changes
