"""Declared checks from states that are kept per range of a table and merge.

A range's state holds the failures that show within it (NULLs, values that repeat) and the
values of its references with their numbers. References are compared with the parent as it
is now, from the states alone. After a change, only states of touched ranges are made anew.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.quality import (
    VALUE, Check, cell, described_checks, parent_keys,
)

STATE_RANGE = "state_range"


def failure_states(ranged: DataFrame, checks: Sequence[Check], own_range: Sequence[str]) -> DataFrame:
    """(state_range, check_name, failures) of not-null and unique checks.

    ``own_range`` names the columns whose value fixes its row's range, so that rows of one
    value share a range; a unique check on any other column is refused.
    """
    nulls = [c for c in checks if c.kind == "not_null"]
    unique = [c for c in checks if c.kind == "unique"]
    strange = [c.name for c in unique if c.column not in own_range]
    if strange:
        raise ValueError(f"values of one kind may lie in several ranges: {', '.join(strange)}")
    counted = ranged.groupBy(STATE_RANGE).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c.column).isNull()).alias(c.name) for c in nulls]
    )
    parts = [counted.drop("rows").unpivot([STATE_RANGE], [c.name for c in nulls], "check_name", "failures")] if nulls else []
    if unique:
        cells = ", ".join(cell(ranged, c.column, place) for place, c in enumerate(unique))
        values = ranged.selectExpr(STATE_RANGE, f"inline(array({cells}))")
        known = values.where("number IS NOT NULL OR bytes IS NOT NULL")
        times = known.groupBy(STATE_RANGE, *VALUE).agg(F.count(F.lit(1)).alias("times"))
        names = F.element_at(F.array(*[F.lit(c.name) for c in unique]), F.col("place") + 1)
        parts.append(
            times.groupBy(STATE_RANGE, names.alias("check_name")).agg(F.count_if(F.col("times") > 1).alias("failures"))
        )
    return reduce(DataFrame.unionByName, parts)


def reference_states(ranged: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(state_range, place, number, bytes, occurrences) of the columns that refer to parents."""
    columns = [c.column for c in checks if c.kind == "relationship"]
    cells = ", ".join(cell(ranged, c, place) for place, c in enumerate(columns))
    values = ranged.selectExpr(STATE_RANGE, f"inline(array({cells}))")
    known = values.where("number IS NOT NULL OR bytes IS NOT NULL")
    return known.groupBy(STATE_RANGE, *VALUE).agg(F.count(F.lit(1)).alias("occurrences"))


def suite_from_states(
    failures: DataFrame, references: DataFrame, parents: Mapping[str, DataFrame], checks: Sequence[Check]
) -> DataFrame:
    """What ``quality.run_suite`` gives for the table, without reading the table."""
    related = [c for c in checks if c.kind == "relationship"]
    within = failures.groupBy("check_name").agg(F.sum("failures").alias("failures"))
    found = within
    if related:
        merged = references.groupBy(*VALUE).agg(F.sum("occurrences").alias("occurrences"))
        known = parent_keys(parents, related, [c.column for c in related])
        same = reduce(lambda a, b: a & b, [merged[c].eqNullSafe(known[c]) for c in VALUE])
        names = F.element_at(F.array(*[F.lit(c.name) for c in related]), F.col("place") + 1)
        orphans = merged.join(known, same, "left_anti").groupBy(names.alias("check_name"))
        found = within.unionByName(orphans.agg(F.sum("occurrences").alias("failures")))
    about = described_checks(failures.sparkSession, checks)
    # A check without a row has met nothing to object to.
    return about.join(found, "check_name", "left").select(
        *about.columns, F.coalesce("failures", F.lit(0)).cast("long").alias("failures"),
        (F.coalesce("failures", F.lit(0)) == 0).alias("passed"),
    )
