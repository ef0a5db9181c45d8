"""Declared data checks, one by one or as a suite.

The suite reads each table once, whatever is checked on it (the plan of a table that is not
written is repeated where a later one is built on it: run it over written tables), and
shuffles only the values of its key columns, in a number or a few bytes, counted map-side
first.
"""

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.audit import run_time
from salesmart.sources.tables import full_refresh


@dataclass(frozen=True)
class Check:
    """One check: ``unique``, ``not_null`` or ``relationship`` (to ``parent.parent_key``)."""

    kind: str
    table: str
    column: str
    parent: str | None = None
    parent_key: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


def _declared() -> tuple[Check, ...]:
    # Table -> (unique columns, not-null columns, references).
    rules = {
        "customers": (
            ("customer_id", "email"),
            ("customer_id", "email", "first_name", "last_name"),
            {},
        ),
        "products": (
            ("product_id",),
            ("product_id", "product_name", "unit_price", "cost_price"),
            {},
        ),
        "orders": (
            (),
            ("order_id", "customer_id", "product_id", "total_amount", "quantity"),
            {"customer_id": ("customers", "customer_id"),
             "product_id": ("products", "product_id")},
        ),
        "stg_customers": (
            ("customer_key", "customer_id", "email"),
            ("customer_key", "customer_id", "email"),
            {},
        ),
        "stg_products": (
            ("product_key", "product_id"),
            ("product_key", "product_id", "unit_price"),
            {},
        ),
        "stg_orders": (
            ("order_key",),
            ("order_key", "customer_id", "product_id", "total_amount"),
            {},
        ),
        "dim_customers": (
            ("customer_key", "customer_id", "email"),
            ("customer_key", "customer_id", "email"),
            {},
        ),
        "dim_products": (
            ("product_key", "product_id"),
            ("product_key", "product_id", "unit_price"),
            {},
        ),
        "dim_dates": (("date_key", "full_date"), ("date_key", "full_date"), {}),
        "fact_orders": (
            ("order_key",),
            ("order_key", "customer_key", "product_key", "date_key", "total_amount"),
            {"customer_key": ("dim_customers", "customer_key"),
             "product_key": ("dim_products", "product_key"),
             "date_key": ("dim_dates", "date_key")},
        ),
    }
    checks = []
    for table, (unique, not_null, references) in rules.items():
        checks += [Check("unique", table, c) for c in unique]
        checks += [Check("not_null", table, c) for c in not_null]
        checks += [Check("relationship", table, c, *to) for c, to in references.items()]
    return tuple(checks)


DECLARED = _declared()


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, value, occurrences)`` of values that occur more than once.

    Values are given as text; NULLs are left out.
    """
    cells = ", ".join(cell(df, c, place) for place, c in enumerate(columns))
    repeated = (
        df.selectExpr(f"inline(array({cells}))")
        .where("number IS NOT NULL OR bytes IS NOT NULL")
        .groupBy(*VALUE)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
    )
    # Values get their text back once only the repeated ones are left.
    text = F.lit(None).cast("string")
    for place, c in enumerate(columns):
        kind = df.schema[c].dataType
        shown = F.col("bytes").cast("string")
        if isinstance(kind, T.IntegralType):
            shown = F.col("number").cast("string")
        elif isinstance(kind, T.DateType):
            shown = F.date_from_unix_date(F.col("number").cast("int")).cast("string")
        elif c.endswith("_key"):
            key = F.octet_length("bytes") == 16
            shown = F.when(key, F.lower(F.hex("bytes"))).otherwise(shown)
        text = F.when(F.col("place") == place, shown).otherwise(text)
    names = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("place") + 1)
    return repeated.select(names.alias("column_name"), text.alias("value"), "occurrences")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, failures)``: number of NULLs per column, in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures")


def check_relationship(
    child: DataFrame, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """``(value, failures)``: non-NULL child values without a parent, with their rows.

    The child is reduced to one row per value first, so a value held by much of the
    table is joined once.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("failures"))
    )
    keys = parent.select(F.col(parent_key).alias("value"))
    return values.join(keys, "value", "left_anti")


def _narrow(df: DataFrame, column: str) -> tuple[str, str]:
    """SQL of a value as a number and as bytes: one of them, in as few bytes as it takes.

    Whole numbers and days are numbers, surrogate keys their 16 bytes instead of 32
    letters, and all else the bytes of its text.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return f"CAST({column} AS BIGINT)", "CAST(NULL AS BINARY)"
    if isinstance(kind, T.DateType):
        return f"CAST(unix_date({column}) AS BIGINT)", "CAST(NULL AS BINARY)"
    text = f"CAST(CAST({column} AS STRING) AS BINARY)"
    if column.endswith("_key"):
        # What is not in lower case, or no hex, would not come back the same.
        hex_ = f"octet_length({column}) = 32 AND {column} = lower({column})"
        text = f"coalesce(IF({hex_}, unhex({column}), NULL), {text})"
    return "CAST(NULL AS BIGINT)", text


VALUE = ("place", "number", "bytes")


def cell(df: DataFrame, column: str, place: int) -> str:
    number, text = _narrow(df, column)
    return f"named_struct('place', {place}, 'number', {number}, 'bytes', {text})"


def _value_counts(df: DataFrame, checks: Sequence[Check], columns: Sequence[str]) -> DataFrame:
    """``(place, number, bytes, occurrences)`` over the checked columns, by their place.

    Every value of the columns to compare; of columns that just must not be NULL, the
    NULLs alone.
    """
    compared = {c.column for c in checks if c.kind != "not_null"}
    cells = []
    for place, name in enumerate(columns):
        value = cell(df, name, place)
        cells.append(value if name in compared else f"IF({name} IS NULL, {value}, NULL)")
    return (
        df.selectExpr(f"inline(array({', '.join(cells)}))")
        .where("place IS NOT NULL")
        .groupBy(*VALUE)
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def parent_keys(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], columns: Sequence[str]
) -> DataFrame | None:
    """Distinct ``(place, number, bytes)`` of the keys the referring columns may hold."""
    keys = []
    for c in checks:
        if c.kind == "relationship":
            parent = tables[c.parent]
            value = cell(parent, c.parent_key, columns.index(c.column))
            keys.append(parent.selectExpr(f"{value} AS cell").select("cell.*"))
    return reduce(DataFrame.unionByName, keys).distinct() if keys else None


def table_failures(
    tables: Mapping[str, DataFrame], table: str, checks: Sequence[Check]
) -> DataFrame:
    """``(check_name, failures)`` for checks of one table, from a single scan of it."""
    columns = list(dict.fromkeys(c.column for c in checks))
    counts = _value_counts(tables[table], checks, columns)
    known = parent_keys(tables, checks, columns)
    if known is None:
        counts = counts.withColumn("known", F.lit(None).cast("boolean"))
    else:
        # Values are single by now: one held by most of the table is joined once.
        known = known.withColumn("known", F.lit(True))
        same = reduce(
            lambda a, b: a & b, [counts[c].eqNullSafe(known[c]) for c in VALUE]
        )
        counts = counts.join(known, same, "left").select(
            *[counts[c] for c in VALUE], "occurrences", "known"
        )

    null = "(number IS NULL AND bytes IS NULL)"
    wrong = {
        "unique": f"IF(occurrences > 1 AND NOT {null}, 1, 0)",
        "not_null": f"IF({null}, occurrences, 0)",
        "relationship": f"IF(known IS NULL AND NOT {null}, occurrences, 0)",
    }
    totals = counts.agg(*[
        F.expr(
            f"coalesce(sum(IF(place = {columns.index(c.column)}, {wrong[c.kind]}, 0)), 0)"
        ).alias(c.name)
        for c in checks
    ])
    return totals.unpivot([], totals.columns, "check_name", "failures")


def described_checks(spark: SparkSession, checks: Sequence[Check]) -> DataFrame:
    """(check_name, kind, table_name, column_name), a row a check."""
    return spark.createDataFrame(
        [(c.name, c.kind, c.table, c.column) for c in checks],
        "check_name string, kind string, table_name string, column_name string",
    )


def run_suite(tables: Mapping[str, DataFrame], checks: Iterable[Check] = DECLARED) -> DataFrame:
    """``(check_name, kind, table_name, column_name, failures, passed)`` for every check."""
    checks = list(checks)
    by_table = {t: [c for c in checks if c.table == t] for t in dict.fromkeys(
        c.table for c in checks)}
    failures = reduce(
        DataFrame.unionByName, [table_failures(tables, t, cs) for t, cs in by_table.items()]
    )
    about = described_checks(failures.sparkSession, checks)
    # One row per declared check on either side.
    return failures.join(F.broadcast(about), "check_name").select(
        *about.columns, "failures", (F.col("failures") == 0).alias("passed")
    )


def failing_rows(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """What a check objects to: repeated values, rows with a NULL, or orphaned values."""
    df = tables[check.table]
    if check.kind == "unique":
        return check_unique(df, [check.column])
    if check.kind == "not_null":
        return df.where(F.col(check.column).isNull())
    return check_relationship(df, check.column, tables[check.parent], check.parent_key)


def store_failures(
    tables: Mapping[str, DataFrame], check: Check, schema: str = "check_failures"
) -> DataFrame:
    """Keep a check's failing rows as the table ``<schema>.<check name>``."""
    return full_refresh(failing_rows(tables, check), f"{schema}.{check.name}")


def rejected_rows(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """The whole rows of a table that a check objects to.

    The values are found on counted ones; the rows are joined to these, which hold each value
    once, so a value on very many rows is met by each of them once.
    """
    df, column = tables[check.table], check.column
    if check.kind == "not_null":
        return df.where(F.col(column).isNull())
    if check.kind == "unique":
        counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_times"))
        wrong = counted.where("_times > 1").select(column)
    else:
        orphans = check_relationship(df, column, tables[check.parent], check.parent_key)
        wrong = orphans.select(F.col("value").alias(column))
    return df.join(wrong, column, "left_semi").select(*df.columns)


def quarantine(
    tables: Mapping[str, DataFrame], check: Check, schema: str = "check_failures"
) -> DataFrame:
    """Keep the rows that a check objects to as ``<schema>.<check name>__rows``."""
    return full_refresh(rejected_rows(tables, check), f"{schema}.{check.name}__rows")


def check_freshness(
    df: DataFrame,
    table: str,
    column: str,
    warn_after: dt.timedelta,
    error_after: dt.timedelta,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """One row with the age of the newest row in seconds and pass, warn or error.

    A table without a dated row is an error.
    """
    age = F.col("age_seconds")
    return (
        df.agg(F.max(column).cast("timestamp_ntz").alias("max_loaded_at"))
        .withColumn("snapshotted_at", run_time(as_of))
        .withColumn(
            "age_seconds", F.timestamp_diff("SECOND", "max_loaded_at", "snapshotted_at")
        )
        .select(
            F.lit(table).alias("table_name"),
            "max_loaded_at",
            "snapshotted_at",
            "age_seconds",
            F.when(age.isNull() | (age > int(error_after.total_seconds())), "error")
            .when(age > int(warn_after.total_seconds()), "warn")
            .otherwise("pass")
            .alias("status"),
        )
    )
