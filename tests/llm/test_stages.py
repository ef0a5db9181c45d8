"""Stages of the pipeline that change texts or rows: what they leave as it was."""

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from cases import documents, empty, frame

NAMES = ("n_lines", "n_deleted", "deleted_runs", "tokens", "weight", "pass_number", "slot")


def with_own(spark):
    own = {c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))) for c in NAMES}
    return frame(spark).withColumns(own)


@pytest.mark.parametrize("stage", [corpus_pipeline.repeated_lines_out, corpus_pipeline.mixed_sources])
def test_own_columns_keep_their_values(spark, stage):
    docs = with_own(spark)
    made = stage(spark, docs, "")
    assert made.schema.simpleString() == docs.schema.simpleString()
    rows = made.collect()
    assert len(rows) >= 20
    for r in rows:
        whose = "?" if r.doc_id is None else str(r.doc_id)
        assert all(r[c] == f"{c} of {whose}" for c in NAMES)


def test_mixing_drops_nothing_and_repeats_at_most_once(spark):
    given = Counter(r[:2] for r in documents())
    made = Counter(tuple(r) for r in corpus_pipeline.mixed_sources(spark, frame(spark), "").select("doc_id", "text").collect())
    assert set(made) == set(given)
    assert all(given[k] <= made[k] <= 2 * given[k] for k in given)


@pytest.mark.parametrize("stage", [corpus_pipeline.repeated_lines_out, corpus_pipeline.mixed_sources])
def test_empty_table(spark, stage):
    docs = empty(spark)
    made = stage(spark, docs, "")
    assert made.count() == 0 and made.columns == docs.columns
