"""Run-time parameters: the business date and the audit stamps."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def business_date(as_of: dt.date | None) -> Column:
    """``as_of``, or today."""
    return F.current_date() if as_of is None else F.lit(as_of)


def run_time(run_ts: dt.datetime | None) -> Column:
    """``run_ts``, or the time of the query, without zone."""
    if run_ts is None:
        return F.localtimestamp()
    return F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")


def stamped(df: DataFrame, run_ts: dt.datetime | None) -> DataFrame:
    """Add the two audit columns every mart table carries."""
    now = run_time(run_ts)
    return df.withColumns({"dw_created_at": now, "dw_updated_at": now})
