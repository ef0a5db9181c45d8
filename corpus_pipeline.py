"""The corpus pipeline: five operators in a row over the documents.

Each stage takes (spark, docs, sf_dir) and returns the documents that go on, in the
columns of ``documents``; the last returns the packed pieces. Between stages the result is
written and read again.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import jaccard, lines, mixing, packing, toxicity
from salesmart.llm.shared import Scratch, table


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the labels, does not reject."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def _aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """The documents' own columns of names that an operator gives its results, under others."""
    own = {c: f"_own_{c}" for c in docs.columns if c in names}
    return docs.withColumnsRenamed(own), own


def _back(rows: DataFrame, docs: DataFrame, own: dict[str, str]) -> DataFrame:
    """The columns of the documents, those put aside among them."""
    return rows.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def repeated_lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that stand earlier; a text of which none is left goes.

    Null and empty texts stay as they are, and so do other columns, whatever their names.
    """
    renamed, own = _aside(docs, "n_lines", "n_deleted", "deleted_runs")
    cleaned = lines.delete_repeated_runs(renamed)
    left = cleaned.where((F.col("n_deleted") == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("n_deleted") == 0, F.col("n_chars")).otherwise(F.char_length("text"))
        left = left.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return _back(left, docs, own)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 of their five-word shingles."""
    return jaccard.one_of_each(docs, jaccard.Similarity(words=5, percent=80))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at tempered weights: every document once, those of scarce sources up to twice.

    Null and empty texts stay; other columns keep their values, whatever their names.
    """
    renamed, own = _aside(docs, "tokens", "weight", "pass_number", "slot")
    return _back(mixing.mix(renamed, mixing.Target(repetitions=2.0)), docs, own)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in sequences of 2048 tokens."""
    windows = packing.Windows(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(docs, windows, with_ids=False).drop("piece_id")


STAGES = [
    ("toxicity", toxic_out),
    ("line dedup", repeated_lines_out),
    ("n-gram Jaccard join", near_copies_out),
    ("mixing sources to target weights", mixed_sources),
    ("packing", packed),
]
# Toxicity is a fitted model, and packing needs a tokenizer: no SQL says the same.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
