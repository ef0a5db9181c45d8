"""Comparing a source with its landed copy by digests, from coarse ranges of keys to keys.

Counts do not show equal numbers of wrong rows. Here every row has a hash, and every range of
keys the sums of its rows' hashes on either side. Only ranges whose sums differ are read
again, in smaller ranges, down to single keys. What is shuffled is a few numbers a range, and
rows of the two sides are never joined to each other.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTHS = (1 << 20, 1 << 10)


def _row_hash(columns: Sequence[str]) -> Column:
    """A hash in which a NULL counts, wherever it stands."""
    cells = [part for c in columns for part in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(*cells)


def _sums(value: Column, name: str) -> list[Column]:
    """Signed sums of the two halves of 64-bit hashes: equal rows add up, none cancel out."""
    low, high = value.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(value, 32)
    return [F.sum(F.col("_side") * half).alias(f"{name}_{i}") for i, half in enumerate((low, high))]


def _both(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of the source with +1 and of the target with -1, in the types of the target."""
    kinds = {f.name.lower(): f.dataType for f in target.schema}
    sides = [
        df.select(*[F.col(c).cast(kinds[c.lower()]).alias(c) for c in columns], F.lit(side).cast("long").alias("_side"))
        for df, side in ((source, 1), (target, -1))
    ]
    return sides[0].unionByName(sides[1])


def differing_ranges(both: DataFrame, key: str, columns: Sequence[str], width: int) -> DataFrame:
    """``_range``: ranges of ``width`` keys (NULL keys are one) whose rows differ."""
    place = F.expr(f"CAST({key} AS BIGINT) div {int(width)}").alias("_range")
    digests = both.groupBy(place).agg(F.sum("_side").alias("n"), *_sums(_row_hash(columns), "h"))
    return digests.where("n <> 0 OR h_0 <> 0 OR h_1 <> 0").select("_range", F.lit(True).alias("_differs"))


def reconcile(
    source: DataFrame,
    target: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    widths: Sequence[int] = WIDTHS,
) -> DataFrame:
    """``(key, source_rows, target_rows, differs_in)`` of every key whose rows differ.

    ``columns`` (all of the target's by default) are compared in the target's types;
    ``differs_in`` lists those whose values differ, in their order. Rows of a key are a bag:
    their order does not matter, how often they occur does. The key is a whole number.
    """
    columns = list(columns or target.columns)
    if key not in columns:
        columns = [key, *columns]
    both = _both(source, target, columns)
    rows = both
    for width in widths:
        wrong = differing_ranges(rows, key, columns, width)
        place = F.expr(f"CAST({key} AS BIGINT) div {int(width)}")
        # One row a differing range: none in a good copy, and then nothing is read again.
        rows = rows.join(wrong, place.eqNullSafe(wrong["_range"]), "left_semi")
    others = [c for c in columns if c != key]
    sums = [s for i, c in enumerate(others) for s in _sums(_row_hash([c]), f"c{i}")]
    counted = [F.count_if(F.col("_side") == side).alias(n) for side, n in ((1, "source_rows"), (-1, "target_rows"))]
    whole = _sums(_row_hash(columns), "h")
    keys = rows.groupBy(key).agg(*counted, *whole, *sums)
    named = [F.when(F.expr(f"c{i}_0 <> 0 OR c{i}_1 <> 0"), F.lit(c)) for i, c in enumerate(others)]
    different = "source_rows <> target_rows OR h_0 <> 0 OR h_1 <> 0"
    return keys.where(different).select(
        key, "source_rows", "target_rows", F.array_compact(F.array(*named)).alias("differs_in")
    )
