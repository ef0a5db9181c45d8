"""Exact decimal arithmetic: amounts, averages and percentages."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Types by name. 18 digits fit a 64-bit word, in Parquet and in Spark's row format alike.
PRICE = "decimal(10,2)"
AMOUNT = "decimal(18,2)"
COUNT = "decimal(18,0)"
PERCENT = "decimal(18,2)"
AVERAGE = "decimal(18,6)"


def to_cents(amount: Column) -> Column:
    """An amount as a whole number of cents (bigint)."""
    return (amount * 100).cast("bigint")


def from_cents(cents: Column, kind: str = AMOUNT) -> Column:
    """A whole number of cents as an amount."""
    return (cents.cast(COUNT) * F.lit("0.01").cast("decimal(2,2)")).cast(kind)


def half_up_div(part: Column, whole: Column) -> Column:
    """Whole-number division rounded half away from zero.

    ``part`` and ``whole`` are best plain columns: each appears more than once.
    """
    half = F.when((part < 0) == (whole < 0), whole).otherwise(-whole)
    return F.call_function("div", part * 2 + half, whole * 2)


def cents_percent(part: Column, whole: Column) -> Column:
    """``percent`` for the amounts of a single row, given in cents.

    Runs on 64-bit whole numbers, several times faster than decimal division, which Spark
    carries out to 38 places. Amounts beyond 4 * 10**12 fail the query.
    """
    return from_cents(half_up_div(part * 10_000, whole), PERCENT)


def percent(part: Column, whole: Column, safe: bool = False) -> Column:
    """``part / whole * 100`` to two places, half up, for amounts up to 10**16.

    A zero ``whole`` fails the query; with ``safe`` it gives NULL. Both sides are narrowed
    first: Spark gives decimal(18,2) / decimal(18,2) twenty decimal places, whereas wider
    operands (sums) would keep as few as six.
    """
    return _decimal_percent(part.cast(AMOUNT), whole.cast(AMOUNT), safe)


def count_percent(part: Column, whole: Column) -> Column:
    """``percent`` for integer counts."""
    return _decimal_percent(part.cast(COUNT), whole.cast(COUNT), False)


def _decimal_percent(part: Column, whole: Column, safe: bool) -> Column:
    ratio = F.try_divide(part, whole) if safe else part / whole
    return F.round(ratio * 100, 2).cast(PERCENT)


def average(total: Column, rows: Column) -> Column:
    """Six-place average of an exact sum; NULL over no rows.

    Spark's own ``avg`` works in doubles for amounts this narrow, which is no longer
    exact once the sum passes 2**53 cents.
    """
    return F.round(F.try_divide(total.cast(AMOUNT), rows.cast(COUNT)), 6).cast(AVERAGE)
