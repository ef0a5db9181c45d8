"""Repeatable pseudo-random draws, a function of row key, seed and draw number alone.

Unlike ``rand`` they do not depend on how rows are spread over tasks, so a retried task
makes the same rows again.
"""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_PER_HASH = 4


def draw(key: Column, seed: int, number: int) -> Column:
    """A whole number from 0 to 2**32 - 1 (bigint); four draws share one MD5."""
    block, part = divmod(number, _PER_HASH)
    digest = F.md5(F.concat_ws("-", key.cast("string"), F.lit(f"{seed}-{block}")))
    return F.conv(F.substring(digest, 1 + 8 * part, 8), 16, 10).cast("long")


def draw_below(key: Column, seed: int, number: int, bound: int | Column) -> Column:
    """A whole number from 0 to ``bound`` - 1."""
    return draw(key, seed, number) % bound


def pick(key: Column, seed: int, number: int, values: Sequence[str]) -> Column:
    """One of ``values``."""
    choices = F.array(*[F.lit(v) for v in values])
    place = draw_below(key, seed, number, len(values)) + 1
    return F.element_at(choices, place.cast("int"))
