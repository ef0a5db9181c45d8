"""Small tables with everything that may be wrong in a large one."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for columns of their own.
CLASHES = (
    "row", "pos", "name", "node", "n", "mark", "sha", "hash", "tokens", "weight", "slot", "score",
    "kept", "length", "start", "offset", "ids", "toxic", "fold", "before", "block", "component",
)


def words(rng: random.Random, n: int) -> list[str]:
    syllables = ("an", "the", "or", "ing", "tion", "é", "ß", "st", "re", "un")
    return ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]


def documents() -> list[tuple]:
    """Copies, near copies, repeated rows and lines, nulls, empty and very long texts."""
    rng = random.Random(3)
    line = lambda n: " ".join(words(rng, n))
    shared, body = line(30), [line(40) for _ in range(6)]
    long = "\n".join(line(60) for _ in range(700))
    texts = ["\n".join([line(25), shared, line(25)]) for _ in range(12)]
    texts += ["\n".join(body)] * 3
    texts += ["\n".join([*body[:5], line(3)]), "\n".join(body).replace("an", "AN", 3)]
    texts += ["", None, " \n\t ", "one", "one two", long, long + " end", "x" * 3000]
    texts += ["Mark A\nMark A\nMark A\nMark A\nMark A", "a\r\nb c   d", "<|endoftext|> ok"]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], rows[12], (None, texts[1], None, None, None), (None, None, None, "s1", 0)]
    rows += [(5, "another text under a number that is taken already", "de", None, None)]
    return rows


def frame(spark, rows=None, clashes=False):
    df = spark.createDataFrame(documents() if rows is None else rows, DOCUMENTS).repartition(3)
    if clashes:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("clash") for c in CLASHES})
    return df


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
