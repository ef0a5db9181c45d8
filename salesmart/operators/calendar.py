"""Day sequences."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The calendar's bounds (the end itself is left out), the day undated
# orders are booked on, and the holidays.
CALENDAR_START = dt.date(1900, 1, 1)
CALENDAR_END = dt.date(2030, 12, 31)
FALLBACK_DAY = dt.date(1900, 1, 1)
HOLIDAYS = (
    FALLBACK_DAY,
    dt.date(2024, 1, 1), dt.date(2024, 7, 4), dt.date(2024, 12, 25),
    dt.date(2025, 1, 1), dt.date(2025, 7, 4), dt.date(2025, 12, 25),
    dt.date(2026, 1, 1), dt.date(2026, 7, 4), dt.date(2026, 12, 25),
)


def date_spine(
    spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> DataFrame:
    """One row ``date_day`` per day from ``start`` up to, not including, ``end``."""
    days = max((end - start).days, 0)
    # A century is 36,525 rows: one task, however wide the cluster.
    tasks = 1 + days // 1_000_000
    return spark.range(0, days, 1, tasks).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day")
    )


def fixed_bounds(
    spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> DataFrame:
    """One row ``(start, end)`` of given days."""
    return spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))


def covering_bounds(
    df: DataFrame,
    column: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """One row ``(start, end)`` whose half-open range holds every day of ``column``.

    ``start`` and ``end`` are bounds to keep even where the data span less.
    """
    first, last = F.min(F.to_date(column)), F.date_add(F.max(F.to_date(column)), 1)
    # least and greatest skip NULL, so no data leaves the given bounds as they are.
    if start is not None:
        first = F.least(F.lit(start), first)
    if end is not None:
        last = F.greatest(F.lit(end), last)
    return df.agg(first.alias("start"), last.alias("end"))


def spine_between(bounds: DataFrame) -> DataFrame:
    """``date_spine`` for bounds held in a one-row ``(start, end)`` frame."""
    return bounds.where("start < end").select(
        F.explode(F.sequence("start", F.date_sub("end", 1))).alias("date_day")
    )
