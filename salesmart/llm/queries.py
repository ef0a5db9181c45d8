"""The registered queries of this subpackage, with SQL where SQL can say the same.

Each applies an operator to its whole table and derives the digest columns from its result.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import (
    alignment, exact, jaccard, lines, mixing, neighbours, packing, planes, quality,
    quotes, repeats, toxicity, variants,
)
from salesmart.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op6_exact_dedup(spark, folder):
    return exact.exact_duplicates(table(spark, folder, "documents"))


ORACLE_SQL["op6_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


@query
def op10_token_files(spark, folder):
    coding = planes.Coding(public_tokenizers.path("byte_bpe_50k.json"))
    return planes.round_trip(table(spark, folder, "documents"), coding)


@query
def op4_packing(spark, folder):
    windows = packing.Windows(public_tokenizers.path("word_bpe_49k.json"))
    docs = table(spark, folder, "documents")
    return packing.pack(docs, windows, with_ids=False).drop("piece_id")


@query
def op1_line_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lines.delete_repeated_runs(docs).drop("deleted_runs")


# Runs as texts: of each line the shortest run of 20 characters that starts, or ends, there.
LINES_SQL = """
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {documents}
), line AS (
    SELECT doc_id, ls, unnest(range(len(ls))) AS pos, unnest(ls) AS l FROM split
), place AS (
    SELECT *, sum(length(l) + 1) OVER (PARTITION BY doc_id ORDER BY pos) AS after,
           sum(length(l) + 1) OVER (PARTITION BY doc_id ORDER BY pos) - length(l) - 1 AS before,
           sum(length(l) + 1) OVER (PARTITION BY doc_id) AS total
    FROM line
), reach AS (
    SELECT doc_id, ls, pos,
           CASE WHEN total - before >= 20 THEN max(pos) OVER (PARTITION BY doc_id ORDER BY before
                RANGE BETWEEN CURRENT ROW AND 19 FOLLOWING) END AS until,
           CASE WHEN after >= 20 THEN min(pos) OVER (PARTITION BY doc_id ORDER BY after
                RANGE BETWEEN 19 PRECEDING AND CURRENT ROW) END AS since
    FROM place
), run AS (
    SELECT doc_id, 0 AS kind, pos AS s, until AS e, array_to_string(ls[pos + 1:until + 1], chr(10)) AS t
    FROM reach WHERE until IS NOT NULL
    UNION ALL
    SELECT doc_id, 1, since, pos, array_to_string(ls[since + 1:pos + 1], chr(10))
    FROM reach WHERE since IS NOT NULL
), later AS (
    SELECT doc_id, s, e, row_number() OVER (PARTITION BY kind, t ORDER BY doc_id, s) AS nth FROM run
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS pos FROM later WHERE nth > 1
), lined AS (
    SELECT doc_id, string_agg(l, chr(10) ORDER BY pos) FILTER (g.pos IS NULL) AS text,
           count(*) AS n_lines, count(g.pos) AS n_deleted
    FROM line LEFT JOIN gone AS g USING (doc_id, pos) GROUP BY doc_id
)
"""
ORACLE_SQL["op1_line_dedup"] = LINES_SQL.format(documents="documents") + """
SELECT doc_id, CASE WHEN n_deleted = 0 THEN d.text ELSE coalesce(lined.text, '') END AS text,
       n_lines::INTEGER AS n_lines, n_deleted::INTEGER AS n_deleted
FROM documents AS d JOIN lined USING (doc_id)
"""


@query
def op8_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return toxicity.score_documents(docs, model).drop("passages")


# Twice at most: scarce sources are read up to two times, the most frequent one once.
MIXTURE = mixing.Target(repetitions=2.0)


@query
def op3_source_mixing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, MIXTURE).drop("text")


@query
def op2_nearest(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), neighbours.Probing())


@query
def op9_jaccard_join(spark, folder):
    docs = table(spark, folder, "documents")
    found = jaccard.jaccard_components(docs, jaccard.Similarity(words=4, percent=85))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op5_quality(spark, folder):
    docs = table(spark, folder, "documents")
    return quality.score_documents(docs, quality.fit(docs, table(spark, folder, "labels")))


@query
def op7_quotation_linking(spark, folder):
    return quotes.link_replies(table(spark, folder, "conversations"))


@query
def op11_spelling_variants(spark, folder):
    return variants.spelling_variants(table(spark, folder, "documents"), variants.Spelling())


@query
def op12_repeated_substrings(spark, folder):
    return repeats.digest(repeats.delete_repeats(table(spark, folder, "documents")))


@query
def op13_token_alignment(spark, folder):
    files = alignment.Tokenizers(*map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))
    return alignment.align_tokens(table(spark, folder, "documents"), files)
