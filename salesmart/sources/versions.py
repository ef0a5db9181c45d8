"""Tables kept in ranges of a key, each range in versions, changed by one switch.

A table ``<schema>.<name>`` is three entries of the catalog: ``<name>__rows`` holds the rows,
partitioned by version and key range; ``<name>__live`` says which version of each range
counts; ``<name>`` is a view of the rows that count. A change writes the ranges it touches
as a new version, which no reader sees yet, and then replaces the small list of live ranges
as a whole (see ``tables.full_refresh``): readers have all of a change or nothing of it, and
a run that fails before the switch leaves the table as it was. Superseded versions stay for
readers that have begun, until ``drop_superseded``.
"""

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.sources.tables import ensure_layer, full_refresh

RANGE, VERSION = "key_range", "version"
_KEY, _WIDTH = "range.key", "range.width"


def _rows_name(table: str) -> str:
    return f"{table}__rows"


def live_ranges(spark: SparkSession, table: str) -> DataFrame:
    """(key_range, version, n_rows) of the ranges that count now."""
    return spark.table(f"{table}__live")


def range_settings(spark: SparkSession, table: str) -> tuple[str, int]:
    """The key of a table of this layout and the width of its ranges."""
    if spark.catalog.tableExists(_rows_name(table)):
        stored = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {_rows_name(table)}").collect()}
        if _KEY in stored:
            return stored[_KEY], int(stored[_WIDTH])
    raise ValueError(f"{table} is not kept in versions of ranges")


def key_ranges(df: DataFrame, key: str, width: int) -> DataFrame:
    """``df`` with its range; a NULL key fails the run, since it belongs to no range."""
    refused = F.raise_error(F.lit(f"{key} is NULL: the row belongs to no range")).cast("long")
    place = F.expr(f"CAST({key} AS BIGINT) div {int(width)}")
    return df.withColumn(RANGE, F.when(F.col(key).isNull(), refused).otherwise(place))


def _new_version(spark: SparkSession, table: str) -> int:
    """A number above all others, by the clock: what a failed run left has another."""
    last = 0
    if spark.catalog.tableExists(f"{table}__live"):
        last = live_ranges(spark, table).agg(F.max(VERSION)).first()[0] or 0
    return max(last + 1, time.time_ns() // 1000)


def _write_version(ranged: DataFrame, table: str) -> DataFrame:
    """Write rows as a new version of their ranges; (key_range, version, n_rows) of it."""
    spark, rows = ranged.sparkSession, _rows_name(table)
    version = _new_version(spark, table)
    placed = ranged.withColumn(VERSION, F.lit(version).cast("long"))
    # The rows of a range are gathered, so that it has few files; large ranges are split.
    gathered = placed.hint("rebalance", RANGE).select(*spark.table(rows).columns)
    gathered.write.insertInto(rows)
    written = spark.table(rows).where(F.col(VERSION) == version)
    return written.groupBy(RANGE, VERSION).agg(F.count(F.lit(1)).alias("n_rows"))


def refresh_versioned(df: DataFrame, table: str, key: str, width: int) -> DataFrame:
    """The whole of ``<schema>.<name>`` as ``df``: made if need be, or switched to at once."""
    spark = df.sparkSession
    schema, _ = table.split(".")
    ensure_layer(spark, schema)
    rows = _rows_name(table)
    ranged = key_ranges(df, key, width)
    if not spark.catalog.tableExists(rows):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema if f.name != RANGE)
        spark.sql(
            f"CREATE TABLE {rows} ({columns}, {VERSION} BIGINT, {RANGE} BIGINT) USING parquet "
            f"PARTITIONED BY ({VERSION}, {RANGE}) TBLPROPERTIES ('{_KEY}' = '{key}', '{_WIDTH}' = '{int(width)}')"
        )
    elif range_settings(spark, table) != (key, width):
        raise ValueError(f"{table} has ranges of another key or width")
    full_refresh(_write_version(ranged, table), f"{table}__live")
    names = ", ".join(f"r.`{c}`" for c in df.columns)
    # The comparison marks the list as selective: its versions prune the scan at run time.
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} AS SELECT {names}, r.{RANGE} FROM {rows} r JOIN {table}__live l "
        f"ON r.{VERSION} = l.{VERSION} AND r.{RANGE} = l.{RANGE} WHERE l.n_rows > 0"
    )
    return spark.table(table).drop(RANGE)


def read_versioned(spark: SparkSession, table: str) -> DataFrame:
    """The rows that count now, also after a change by another session."""
    for name in (f"{table}__live", _rows_name(table)):
        spark.catalog.refreshTable(name)
    return spark.table(table).drop(RANGE)


def touched_ranges(spark: SparkSession, table: str, *keyed: DataFrame) -> DataFrame:
    """Distinct ranges of the keys that the frames hold."""
    key, width = range_settings(spark, table)
    ranges = None
    for df in keyed:
        found = key_ranges(df.select(key), key, width).select(RANGE)
        ranges = found if ranges is None else ranges.union(found)
    return ranges.distinct()


def rows_of_ranges(spark: SparkSession, table: str, touched: DataFrame) -> DataFrame:
    """The rows, with their range, of the ranges that ``touched`` lists."""
    low, high = touched.agg(F.min(RANGE), F.max(RANGE)).first()
    # Bounds leave out folders when the scan is planned, the list itself those between.
    within = spark.table(table).where(F.col(RANGE).between(low, high))
    return within.join(touched, RANGE, "left_semi")


def replace_keys(rows: DataFrame, table: str, changed: DataFrame) -> DataFrame:
    """Every row of the keys in ``changed`` leaves; ``rows`` come. One switch for all ranges.

    All rows of a key change together, so a key may stand on many rows, and a key that
    ``rows`` lack is deleted. Ranges without such keys are neither read nor written. A row
    of ``rows`` whose key is not in ``changed`` fails the run.
    """
    spark = rows.sparkSession
    key, width = range_settings(spark, table)
    keys = changed.select(key).distinct()
    strays = rows.select(key).join(keys, key, "left_anti")
    if not strays.isEmpty():
        raise ValueError(f"rows of a {key} that is not among the changed ones")
    touched = touched_ranges(spark, table, keys)
    kept = rows_of_ranges(spark, table, touched).join(keys, key, "left_anti")
    merged = kept.unionByName(key_ranges(rows, key, width))
    written = _write_version(merged, table)
    untouched = live_ranges(spark, table).join(touched, RANGE, "left_anti")
    full_refresh(untouched.unionByName(written), f"{table}__live")
    return spark.table(table).drop(RANGE)


def drop_superseded(spark: SparkSession, table: str) -> int:
    """Delete versions of ranges that no longer count; the number of them.

    To be called when no reader of an older state is left.
    """
    rows = _rows_name(table)
    listed = spark.sql(f"SHOW PARTITIONS {rows}").select(
        *[F.regexp_extract("partition", f"{c}=(-?[0-9]+)", 1).cast("long").alias(c) for c in (VERSION, RANGE)]
    )
    old = listed.join(live_ranges(spark, table), [VERSION, RANGE], "left_anti").collect()
    for first in range(0, len(old), 200):
        parts = [f"PARTITION ({VERSION} = {r.version}, {RANGE} = {r.key_range})" for r in old[first : first + 200]]
        spark.sql(f"ALTER TABLE {rows} DROP IF EXISTS {', '.join(parts)}")
    spark.catalog.refreshTable(rows)
    return len(old)
