"""Joins from a large table to a lookup table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "left",
    salts: int = 1,
    spread_by: str | None = None,
) -> DataFrame:
    """Join ``large`` to ``lookup`` on ``key`` (``how``: left or inner).

    No hint is given: Spark broadcasts the lookup when its size, estimated or measured at
    run time, is under the session's threshold, and otherwise shuffles both sides. In the
    shuffled form a key (or NULL) that holds much of ``large`` makes one oversized
    partition, which adaptive execution splits over several tasks.

    ``salts`` above 1 spreads every key over that many partitions up front, for sessions
    where the split is off: rows of ``large`` draw a salt from ``spread_by`` and each
    lookup row is repeated once per salt.
    """
    if salts == 1:
        return large.join(lookup, key, how)
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return (
        large.withColumn("_salt", salt)
        .join(lookup.withColumn("_salt", copies), [key, "_salt"], how)
        .drop("_salt")
    )
