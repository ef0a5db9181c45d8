"""Named tables: layers, whole-table replacement, loading and range-wise merging."""

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.landing import conform, fit_widths, normalize_names, upsert
from salesmart.schemas import LANDING, WIDTHS

LANDING_LAYER = "landing"
_RANGE = "key_range"


def layer_name(layer: str, prefix: str | None = None) -> str:
    """Schema name of a layer: the plain name, or ``<prefix>_<layer>``."""
    return f"{prefix}_{layer}" if prefix else layer


def ensure_layer(spark: SparkSession, schema: str) -> str:
    """Create the schema if needed; return the folder its tables live under."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    folder = spark.catalog.getDatabase(schema).locationUri.rstrip("/")
    refuse_local(spark.sparkContext.master, folder)
    return folder


def refuse_local(master: str, folder: str) -> None:
    """Tables of a cluster belong in a store that all its machines see."""
    if folder.startswith("file:") and not master.startswith("local"):
        raise ValueError(f"{folder} is local: set spark.sql.warehouse.dir to a shared store")


def bind(spark: SparkSession, schema: str, tables: Sequence[str]) -> dict[str, DataFrame]:
    """Logical table names bound to the tables of a schema."""
    return {t: spark.table(f"{schema}.{t}") for t in tables}


def publish_views(views: Mapping[str, DataFrame], prefix: str | None = None) -> None:
    """Keep staging results virtual: each name, after ``prefix``, becomes a temporary view."""
    for name, df in views.items():
        df.createOrReplaceTempView(layer_name(name, prefix))


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    detail = rows[[r.col_name for r in rows].index("# Detailed Table Information"):]
    return {r.col_name: r.data_type for r in detail}


def _location(spark: SparkSession, table: str) -> str:
    return _details(spark, table)["Location"].rstrip("/")


def _live_location(spark: SparkSession, table: str) -> str | None:
    if not spark.catalog.tableExists(table):
        return None
    location = _location(spark, table)
    if not location.endswith(("/a", "/b")):
        raise ValueError(f"{table} was not written by full_refresh; refusing to replace it")
    return location


def _recover(spark: SparkSession, table: str) -> None:
    """Undo what a failed change of the schema may have left in the catalog."""
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(f"{table}__old"):
        spark.sql(f"ALTER TABLE {table}__old RENAME TO {table}")
    for name in (f"{table}__old", f"{table}__next"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@dataclass(frozen=True)
class Staged:
    """Rows complete in a table's spare folder, which readers do not see yet."""

    table: str
    folder: str
    live: str | None
    rows: DataFrame


def stage(df: DataFrame, table: str) -> Staged:
    """Write ``df`` to the folder of ``<schema>.<name>`` that is not in use."""
    spark = df.sparkSession
    schema, name = table.split(".")
    folder = f"{ensure_layer(spark, schema)}/{name}"
    _recover(spark, table)
    live = _live_location(spark, table)
    spare = f"{folder}/{'b' if live and live.endswith('/a') else 'a'}"
    rejected = f"{table}__rejected"
    known = live is not None or spark.catalog.tableExists(rejected)
    spark.sql(f"DROP TABLE IF EXISTS {rejected}")  # the entry; its folder is the spare one
    df.write.mode("overwrite" if known else "errorifexists").parquet(spare)
    return Staged(table, spare, live, spark.read.schema(df.schema).parquet(spare))


def reject(staged: Staged) -> DataFrame:
    """Leave the table as it is; what was staged becomes ``<table>__rejected`` until the next."""
    spark, name = staged.rows.sparkSession, f"{staged.table}__rejected"
    spark.catalog.createTable(name, path=staged.folder, source="parquet", schema=staged.rows.schema)
    return spark.table(name)


def publish(staged: Staged) -> DataFrame:
    """Show what was staged in place of the rows before; the new table.

    New columns take a second table, which then changes names with the first: if that
    fails, the old one keeps its name, or has it again by the next run.
    """
    table, spare, schema = staged.table, staged.folder, staged.rows.schema
    spark = staged.rows.sparkSession
    if staged.live is None:
        spark.catalog.createTable(table, path=spare, source="parquet", schema=schema)
    elif spark.table(table).schema.simpleString() == schema.simpleString():
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{spare}'")
        spark.catalog.refreshTable(table)
    else:
        # Names and catalog entries only: the folders of an external table stay.
        spark.catalog.createTable(f"{table}__next", path=spare, source="parquet", schema=schema)
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}__old")
        spark.sql(f"ALTER TABLE {table}__next RENAME TO {table}")
        spark.sql(f"DROP TABLE {table}__old")
    return spark.table(table)


def full_refresh(df: DataFrame, table: str) -> DataFrame:
    """Replace the whole of ``<schema>.<name>`` with ``df`` and return the new table.

    A table has two folders, ``a`` and ``b``. The new rows go to the one not in use; only
    when they are complete is the table pointed at it, so a failed run leaves the old
    version in place, ``df`` may read the table it replaces, and no data are moved. Frames
    read before the switch stay valid until the refresh after it. One writer at a time.
    Folders of a table that the catalog does not know are not overwritten.
    """
    return publish(stage(df, table))


def load_all(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    schema: str = LANDING_LAYER,
    cut: bool = False,
) -> dict[str, DataFrame]:
    """Extract and land every source table in turn; the first failure ends the run.

    A text longer than its column fails the run too, or is cut on request. Verify the
    result with ``operators.verify.verify_landing``.
    """
    return {name: full_refresh(rows, f"{schema}.{name}") for name, rows in landing_rows(read, cut)}


def landing_rows(read: Callable[[str], DataFrame], cut: bool = False) -> Iterator[tuple[str, DataFrame]]:
    """Each source table by name, in the shape in which it is landed."""
    for name, layout in LANDING.items():
        rows = fit_widths(conform(read(name), layout), WIDTHS.get(name, {}), cut)
        yield name, normalize_names(rows)


# Tables in ranges of a key ---------------------------------------------------------------

_KEY, _WIDTH = "range.key", "range.width"


def create_ranged(df: DataFrame, table: str, key: str, width: int) -> DataFrame:
    """Write ``<schema>.<name>`` split into ranges of ``width`` values of an integer key.

    Key and width are kept with the table. A NULL key fails the run before anything is
    written; the rows of a range are gathered, so that it has few files.
    """
    spark = df.sparkSession
    schema, name = table.split(".")
    _refuse_nulls(df, key)
    path = f"{ensure_layer(spark, schema)}/{name}/{uuid.uuid4().hex[:12]}"
    rows = df.withColumn(_RANGE, F.expr(f"{key} div {int(width)}")).hint("rebalance", _RANGE)
    rows.write.partitionBy(_RANGE).option("path", path).saveAsTable(table)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_KEY}' = '{key}', '{_WIDTH}' = '{int(width)}')")
    return spark.table(table)


def _refuse_nulls(df: DataFrame, key: str) -> None:
    if not df.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"{key} has NULLs: a row without a key belongs to no range")


def stored_range(spark: SparkSession, table: str) -> tuple[str, int]:
    """The key of a table of ``create_ranged`` and the width of its ranges."""
    stored = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if _KEY not in stored:
        raise ValueError(f"{table} was not written by create_ranged")
    return stored[_KEY], int(stored[_WIDTH])


def rows_of_keys(changes: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Stored rows with the keys of ``changes``, read from the ranges of these alone."""
    spark = changes.sparkSession
    range_key, width = stored_range(spark, table)
    wanted = changes.select(*keys).withColumn(_RANGE, F.expr(f"{range_key} div {width}"))
    return spark.table(table).join(wanted, [_RANGE, *keys], "left_semi").drop(_RANGE)


def merge_ranged(
    changes: DataFrame, table: str, keys: Sequence[str], removed: DataFrame | None = None
) -> DataFrame:
    """``upsert`` into a table of ``create_ranged``, rewriting only the ranges it touches.

    The table's range key must be one of ``keys``, so that a row never moves between
    ranges; rows whose keys ``removed`` lists go. NULL range keys are refused before
    anything is written, and a key changed twice fails the run. Orders arrive with rising
    ids, hence a batch of recent orders touches few ranges, and the rest of the table is
    neither read (its ranges are pruned at run time) nor written.

    Touched ranges are written whole to a new folder; only then are they switched over,
    one by one in the catalog. The old files stay, so a run that fails at any point can be
    repeated: what is switched is complete, and what is not is as it was.
    """
    spark = changes.sparkSession
    range_key, width = stored_range(spark, table)
    if range_key not in keys:
        raise ValueError(f"the range key {range_key} must be one of the keys")

    def ranged(df: DataFrame) -> DataFrame:
        _refuse_nulls(df, range_key)
        return df.withColumn(_RANGE, F.expr(f"{range_key} div {width}"))

    places = [*keys, _RANGE]
    current, changes = spark.table(table), ranged(changes)
    touched = changes.select(_RANGE)
    if removed is not None:
        removed = ranged(removed.select(*keys)).select(*places)
        touched = touched.union(removed.select(_RANGE))
    kept = current.join(touched.distinct(), _RANGE, "left_semi").select(*current.columns)
    if removed is not None:
        kept = kept.join(removed, places, "left_anti").select(*current.columns)
    merged = upsert(kept, changes.select(*current.columns), places)
    base = _location(spark, table).rpartition("/")[0]
    folder = f"{base}/{uuid.uuid4().hex[:12]}"
    merged.hint("rebalance", _RANGE).write.partitionBy(_RANGE).parquet(folder)
    written = spark.read.schema(current.schema).parquet(folder).select(_RANGE).distinct()
    emptied = touched.distinct().join(written, _RANGE, "left_anti")
    for row in written.toLocalIterator():
        place = f"PARTITION ({_RANGE} = {row[0]})"
        path = f"{folder}/{_RANGE}={row[0]}"
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {place} LOCATION '{path}'")
        spark.sql(f"ALTER TABLE {table} {place} SET LOCATION '{path}'")
    for row in emptied.toLocalIterator():  # ranges of which every row was removed
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_RANGE} = {row[0]})")
    spark.catalog.refreshTable(table)
    return spark.table(table)
