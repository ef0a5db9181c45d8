"""Shaping rows for the landing tables, and changing rows already landed."""

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.audit import run_time


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types, whatever ``df`` has.

    Names match without regard to case. A column the source lacks is an error: see
    ``fill_defaults``.
    """
    return df.selectExpr(*[
        f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema
    ])


def fit_widths(df: DataFrame, widths: Mapping[str, int], cut: bool = False) -> DataFrame:
    """Text columns within their declared widths: a longer text is cut, or fails the run."""
    if cut:
        return truncate_to(df, widths)

    def checked(name: str, width: int) -> Column:
        too_long = F.raise_error(F.lit(f"{name} is longer than {width} characters"))
        return F.when(F.char_length(name) > width, too_long.cast("string")).otherwise(F.col(name))

    return df.withColumns({c: checked(c, n) for c, n in widths.items()})


def normalize_names(df: DataFrame) -> DataFrame:
    """Column names in capitals. Spark resolves either spelling."""
    return df.toDF(*[c.upper() for c in df.columns])


def fill_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add columns that are absent with their default; NULLs already there stay NULL."""
    present = {c.lower() for c in df.columns}
    return df.withColumns({c: v for c, v in defaults.items() if c.lower() not in present})


def truncate_to(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Cut text columns to their declared widths (in characters)."""
    return df.withColumns({c: F.substring(c, 1, n) for c, n in widths.items()})


def upsert(target: DataFrame, changes: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``target`` with rows of ``changes`` replacing those of equal key, or added.

    A key that ``changes`` hold twice fails the run (see ``latest_changes``). With a small
    change set Spark broadcasts it and ``target`` is not shuffled. Neither input is written
    to: land the result with ``sources.tables.full_refresh``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    changes = single_changes(changes, keys)
    kept = target.join(changes.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(changes)


def single_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``changes`` as they are; the run fails if one of their keys stands on two rows."""
    rest = [c for c in changes.columns if c not in keys]
    row = F.struct(*rest) if rest else F.struct(F.lit(True).alias("_none"))
    once = F.assert_true(F.col("_times") == 1, F.lit("a key is changed twice")).isNull()
    return (
        changes.groupBy(*keys)
        .agg(F.max(row).alias("_row"), F.count(F.lit(1)).alias("_times"))
        .where(once)
        .select(*keys, "_row.*")
        .select(*changes.columns)
    )


def latest_changes(changes: DataFrame, key: str | Sequence[str], by: str) -> DataFrame:
    """The newest row of each key; rows of equal ``by`` are settled by their content.

    An aggregate, not a window: a key with very many changes is reduced before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in changes.columns if c not in keys and c != by]
    newest = F.max(F.struct(by, *rest)).alias("_newest")
    reduced = changes.groupBy(*keys).agg(newest)
    return reduced.select(*keys, "_newest.*").select(*changes.columns)


def merge_ordered(
    stored: DataFrame, changes: DataFrame, key: str | Sequence[str], by: str, deleted: str
) -> DataFrame:
    """``stored`` after ``changes``, in whatever order and parts they arrive.

    Of all rows of a key the one newest by ``by`` stays; of equally new ones a deletion, then
    the largest content. Deleted rows stay as marks (``deleted`` is true), since an older
    change may still come after them: see ``live_rows``. The result is a maximum per key, so
    merging is repeatable, and its order and grouping do not matter.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in stored.columns if c not in keys and c not in (by, deleted)]
    newest = F.max(F.struct(by, deleted, *rest)).alias("_newest")
    reduced = stored.unionByName(changes).groupBy(*keys).agg(newest)
    return reduced.select(*keys, "_newest.*").select(*stored.columns)


def live_rows(stored: DataFrame, deleted: str) -> DataFrame:
    """Rows that are not marked as deleted, without the mark."""
    return stored.where(~F.col(deleted)).drop(deleted)


def touch_updated_at(
    changes: DataFrame,
    target: DataFrame,
    key: str | Sequence[str],
    ts: dt.datetime | None = None,
) -> DataFrame:
    """Stamp ``updated_at`` on changes to rows that exist; new rows keep theirs."""
    keys = [key] if isinstance(key, str) else list(key)
    # Only keys that the changes name are made distinct, not those of the whole target.
    existing = (
        target.select(*keys).join(changes.select(*keys), keys, "left_semi").distinct()
        .withColumn("_exists", F.lit(True))
    )
    stamp = F.when(F.col("_exists"), run_time(ts)).otherwise(F.col("updated_at"))
    return (
        changes.join(existing, keys, "left")
        .withColumn("updated_at", stamp)
        .select(*changes.columns)
    )
