"""The fact by month: reports of some months read the files of these months only."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.plans.finance import MONTHS, period_report, period_totals
from salesmart.sources.versions import RANGE, live_ranges, refresh_versioned

MONTH = "month_number"


def write_months(fact: DataFrame, dim_dates: DataFrame, table: str) -> DataFrame:
    """Keep the fact as ``<schema>.<name>``, one range a calendar month (year * 100 + month)."""
    months = dim_dates.select("date_key", (F.col("year") * 100 + F.col("month")).alias(MONTH))
    return refresh_versioned(fact.join(months, "date_key").select(*fact.columns, MONTH), table, MONTH, 1)


def facts_of(spark: SparkSession, table: str, calendar: DataFrame) -> DataFrame:
    """Fact rows of the months that a filtered calendar has.

    The months found at run time prune the scan, if the calendar's filter is selective.
    """
    months = calendar.select((F.col("year") * 100 + F.col("month")).cast("long").alias(RANGE)).distinct()
    return spark.table(table).join(months, RANGE, "left_semi").drop(RANGE)


def latest_report(spark: SparkSession, table: str, dim_dates: DataFrame, k: int = 12, safe: bool = False) -> DataFrame:
    """The last ``k`` months of the monthly report, latest first.

    Which months there are is known from the list of live ranges. The month before them is
    read as well, for the growth of the first.
    """
    kept = live_ranges(spark, table).orderBy(F.desc(RANGE)).limit(k + 1).collect()  # k + 1 rows
    months = [r[RANGE] for r in kept]
    fact = spark.table(table).where(F.col(RANGE).isin(months)).drop(RANGE, MONTH)
    report = period_report(period_totals(fact, dim_dates), MONTHS, safe)
    return report.orderBy(F.desc("year"), F.desc("month")).limit(k)
