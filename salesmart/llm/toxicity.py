"""Toxic passages by maximum-scoring segments of token log-odds (operator 8).

A token's score is its log-odds between toxic and clean labelled documents, with Dirichlet
priors: a word's prior is the share of its first five bytes, theirs that of the first four
bytes, theirs that of the whole corpus, so that rare and unseen forms lean on their stem.
Counts are exact and kept in a written table by the 64-bit hash of the token, which grows
with the words of the corpus. The most frequent ones, at most ``HEAD``, go to every task;
the scores of rarer tokens are joined to the documents that have them. No scored text is
shuffled for it: a scan depends on the positive scores and on sums between them only, so a
document waits for its rare scores as these numbers (its *outline*). A Bloom filter of
fixed size tells which words may have rare counts, and only those are looked up; when it
fills up, more words are, and scores stay the same.

Scores less a drift are negative on average in clean text. One pass over a document finds
all maximal scoring segments (every one that cannot be made better by growing or
shrinking). What a segment is worth follows from the extreme values of clean text: the
best of n tokens exceeds S by chance about K n exp(-lambda S) times, with lambda from the
clean tokens' scores and K from clean documents. A document's evidence is its best
segment's excess and the sum over all significant segments, brought to a probability by
a logistic fit on labelled documents that were not counted.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.logistic import fit_logistic, sigmoid
from salesmart.llm.shared import Rolling, Scratch, batches, byte_table, plain_text, stretches

HEAD = 1 << 18  # counts of words and prefixes at most that every task gets
BITS = 26  # bits, as a power of two, of the filter that tells which other counts there may be
FLUSH = 500_000  # tokens counted at a time
PREFIXES = (5, 4)
STRENGTHS = (4.0, 8.0, 16.0)  # prior counts of a word, of five and of four bytes
DRIFT = 1.0
FIT_ROWS = 50_000  # labelled rows at most in the last fit
LETTERS = byte_table(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
TOKEN_COUNTS = "kind int, key long, toxic long, clean long"
NAMES = ("word", "five", "four")  # kinds 0, 1, 2
EVIDENCE = "doc_id long, toxic int, tokens long, best double, total double"


@dataclass
class Model:
    """Counts per class of frequent tokens, all counts as a table, and what calibration found.

    ``keys`` are sorted hashes of each kind (word, five bytes, four bytes), kind after kind
    between ``bounds``, and ``toxic`` and ``clean`` their counts. ``counts`` is the written
    table if it has more than these, else None; tokens that occur ``least`` times are among
    the frequent ones, and so are their prefixes.
    """

    keys: np.ndarray
    bounds: list[int]
    toxic: np.ndarray
    clean: np.ndarray
    totals: np.ndarray
    counts: DataFrame | None = None
    least: int = 1
    drift: float = DRIFT
    lam: float = 1.0
    log_k: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.array([-4.0, 0.0, 0.0]))
    rare: np.ndarray | None = None  # the filter of keys that are only in the table
    sent: Broadcast | None = None

    def local(self, spark: SparkSession) -> "Sent":
        """What tasks need of it: no more than ``HEAD`` counts, sent once."""
        if self.sent is None:
            self.sent = spark.sparkContext.broadcast((self.keys, self.toxic, self.clean, self.rare))
        return Sent(replace(self, counts=None, sent=None, keys=None, toxic=None, clean=None, rare=None), self.sent)

    def places(self, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the keys are in the arrays, and whether they are there."""
        own = self.keys[self.bounds[kind] : self.bounds[kind + 1]]
        if not len(own):
            return np.zeros(len(keys), int), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
        return at + self.bounds[kind], own[at] == keys

    def unsure(self, keys: np.ndarray) -> np.ndarray:
        """Whether words outside the arrays, or their prefixes, may have counts in the table."""
        out = np.zeros(keys.shape[1], bool)
        if self.rare is not None:
            for kind in range(len(NAMES)):
                maybe = ~self.places(kind, keys[kind])[1]
                for bit in _bits(keys[kind]):
                    maybe &= (self.rare[bit >> 6] >> (bit & 63)) & 1 == 1
                out |= maybe
            out &= ~self.places(0, keys[0])[1]
        return out

    def odds(self, keys: np.ndarray, rare: tuple | None = None) -> np.ndarray:
        """Scores of tokens given by their three keys; ``rare`` has keys and scores of words."""
        share = np.full(keys.shape[1], self.base())
        for kind, strength in zip((2, 1, 0), reversed(STRENGTHS)):
            at, known = self.places(kind, keys[kind])
            toxic, clean = np.zeros(len(at)), np.zeros(len(at))
            toxic[known], clean[known] = self.toxic[at[known]], self.clean[at[known]]
            toxic, clean = toxic + strength * share, clean + strength * (1 - share)
            share = toxic / (toxic + clean)
        out = np.log(share / (1 - share)) - self.offset()
        if rare is not None and len(rare[0]):
            words, scores = np.asarray(rare[0], np.int64), np.asarray(rare[1], float)
            order = np.argsort(words)
            words, scores = words[order], scores[order]
            at = np.minimum(np.searchsorted(words, keys[0]), len(words) - 1)
            out = np.where(words[at] == keys[0], scores[at], out)
        return out

    def base(self) -> float:
        totals = np.maximum(self.totals, 1.0)
        return float(totals[0] / totals.sum())

    def offset(self) -> float:
        totals = np.maximum(self.totals, 1.0)
        return float(np.log(totals[0] / totals[1]) + self.drift)

    def column(self) -> Column:
        """The score of a row with toxic_word, clean_word, ..., as ``odds`` has it."""
        share = F.lit(self.base())
        for kind, strength in zip((2, 1, 0), reversed(STRENGTHS)):
            toxic, clean = (
                F.coalesce(F.col(f"{c}_{NAMES[kind]}"), F.lit(0)) for c in ("toxic", "clean")
            )
            share = (toxic + strength * share) / (toxic + clean + F.lit(strength))
        return F.log(share / (1 - share)) - self.offset()


def _bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each key in the filter."""
    return keys & ((1 << BITS) - 1), (keys >> BITS) & ((1 << BITS) - 1)


def _filter(keys: DataFrame) -> np.ndarray:
    """The filter's bits, in 64-bit words: a sum over all keys of a size that does not grow."""
    mask = (1 << BITS) - 1
    bit = F.explode(F.array(
        F.col("key").bitwiseAND(F.lit(mask)), F.shiftright("key", BITS).bitwiseAND(F.lit(mask))
    ))
    words = keys.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("place")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("bits")
    ).toArrow()
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[np.asarray(words.column("place"))] = np.asarray(words.column("bits"))
    return out


def token_keys(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its tokens' keys [3, n] and byte ranges [2, n]; letters only, lower case.

    Long texts take the memory of their own arrays; short ones share a pass.
    """
    raw = [t.lower().encode() for t in texts]
    for first, last in batches(raw):
        group = raw[first:last]
        data = np.frombuffer(b"\n".join(group), np.uint8)
        begin, end = stretches(LETTERS[data])
        rolling = Rolling(data)
        stops = [end, *[np.minimum(begin + p, end) for p in PREFIXES]]
        keys = np.stack([rolling.hashes(begin, s).view(np.int64) for s in stops])
        starts = np.cumsum([0, *[len(t) + 1 for t in group]])
        bounds = np.searchsorted(begin, starts)
        for i in range(len(group)):
            part = slice(bounds[i], bounds[i + 1])
            yield keys[:, part], np.stack([begin[part], end[part]]) - starts[i]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, after last, score), in linear time.

    The scan steps over positive scores; what lies between matters by its sum only. Every
    candidate keeps the running sum before it (low) and at its end (high), and which
    candidate to its left is the nearest with a smaller low.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    places = np.flatnonzero(scores > 0)
    first, after, low, high, lower = [], [], [], [], []
    for i, before, at_end in zip(places.tolist(), sums[places].tolist(), sums[places + 1].tolist()):
        start, least, j = i, before, len(low) - 1
        while True:
            while j >= 0 and low[j] >= least:
                j = lower[j]
            if j < 0 or high[j] >= at_end:
                break
            start, least, j = first[j], low[j], lower[j]
            # Everything from the joined candidate on is part of the new one.
            keep = len(first) - 1
            while first[keep] != start:
                keep -= 1
            for column in (first, after, low, high, lower):
                del column[keep:]
        first.append(start)
        after.append(i + 1)
        low.append(least)
        high.append(at_end)
        lower.append(j)
    return [(a, b, h - l) for a, b, l, h in zip(first, after, low, high)]


def fold(key: Column) -> Column:
    """crc32 of the doc_id as text, modulo 5; 0 is held out. A null id is held out."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5


def _counted(found: list[tuple[int, np.ndarray]]) -> Iterator[pd.DataFrame]:
    toxic = np.concatenate([np.full(keys.shape[1], t != 0) for t, keys in found])
    keys = np.concatenate([keys for _, keys in found], axis=1)
    for kind in range(len(NAMES)):
        each, place = np.unique(keys[kind], return_inverse=True)
        both = np.bincount(place, minlength=len(each))
        bad = np.bincount(place[toxic], minlength=len(each))
        yield pd.DataFrame({"kind": np.int32(kind), "key": each, "toxic": bad, "clean": both - bad})


def _counts(batches_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of words and prefixes, of about FLUSH tokens at a time."""
    found, size = [], 0
    for batch in batches_:
        for toxic, (keys, _) in zip(batch["toxic"], token_keys(list(batch["text"]))):
            found.append((toxic, keys))
            size += keys.shape[1]
            if size >= FLUSH:
                yield from _counted(found)
                found, size = [], 0
    if found:
        yield from _counted(found)


def _rare_tokens(sent: "Sent"):
    """Of each text the words that may have rare counts, with their prefixes."""

    def run(batches_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.open()
        for batch in batches_:
            rows, found = [], []
            for i, (keys, _) in enumerate(token_keys(list(batch["text"]))):
                keys = keys[:, model.unsure(keys)]
                keys = keys[:, np.unique(keys[0], return_index=True)[1]]
                rows.append(np.full(keys.shape[1], i))
                found.append(keys)
            if found:
                rows, keys = np.concatenate(rows), np.concatenate(found, axis=1)
                yield pd.DataFrame({
                    "_text_a": batch["_text_a"].to_numpy()[rows],
                    "_text_b": batch["_text_b"].to_numpy()[rows],
                    **dict(zip(NAMES, keys)),
                })

    return run


def with_rare(rows: DataFrame, model: Model, scratch: Scratch, name: str) -> DataFrame:
    """The rows with _rare_words and _rare_scores: what frequent tokens do not tell of a text.

    Texts are known by two hashes; copies add nothing to the set of a text's words.
    """
    kind = "array<{}>"
    if model.counts is None:
        return rows.withColumns({
            "_rare_words": F.lit(None).cast(kind.format("long")),
            "_rare_scores": F.lit(None).cast(kind.format("double")),
        })
    text = ["_text_a", "_text_b"]
    rows = rows.withColumns({
        "_text_a": F.xxhash64(plain_text()), "_text_b": F.xxhash64(F.lit(1), plain_text())
    })
    schema = "_text_a long, _text_b long, word long, five long, four long"
    rare = scratch.write(
        rows.select(*text, plain_text().alias("text"))
        .mapInPandas(_rare_tokens(model.local(rows.sparkSession)), schema),
        f"rare-{name}",
    )
    told = _told(rare, text, model)
    return rows.join(told.hint("merge"), text, "left").drop(*text)


def _told(rare: DataFrame, row: list[str], model: Model) -> DataFrame:
    """Per row the words, and their scores, whose counts are not all among the frequent ones."""
    words = rare.select(*NAMES).distinct()
    for number, column in enumerate(NAMES):
        counts = model.counts.where(F.col("kind") == number).select(
            F.col("key").alias(column), F.col("toxic").alias(f"toxic_{column}"),
            F.col("clean").alias(f"clean_{column}"),
        )
        words = words.join(counts.hint("merge"), column, "left")
    # If no count of a word is missing from the frequent ones, the task has its score.
    missing = F.lit(False)
    for column in NAMES:
        n = F.col(f"toxic_{column}") + F.col(f"clean_{column}")
        missing = missing | F.coalesce(n < model.least, F.lit(False))
    scores = words.where(missing).select("word", model.column().alias("score"))
    return rare.select(*row, "word").join(scores.hint("merge"), "word").groupBy(*row).agg(
        F.collect_set(F.struct("word", "score")).alias("rare")
    ).select(
        *row, F.transform("rare", lambda x: x["word"]).alias("_rare_words"),
        F.transform("rare", lambda x: x["score"]).alias("_rare_scores"),
    )


def _rare_of(batch: pd.DataFrame) -> list[tuple | None]:
    pairs = zip(batch["_rare_words"], batch["_rare_scores"])
    return [None if words is None else (words, scores) for words, scores in pairs]


def _excess(score, tokens, model: Model):
    """By how much a segment's score beats the best that chance gives in so many tokens."""
    return model.lam * score - model.log_k - np.log(np.maximum(tokens, 1))


@dataclass(frozen=True)
class Sent:
    """A model whose arrays tasks read from the broadcast that all its uses share."""

    numbers: Model
    arrays: Broadcast

    def open(self) -> Model:
        keys, toxic, clean, rare = self.arrays.value
        return replace(self.numbers, keys=keys, toxic=toxic, clean=clean, rare=rare)


SIGNIFICANT = float(np.log(20))  # expected less than 0.05 times by chance


def _weighed(n: int, scores: np.ndarray, begin: np.ndarray, end: np.ndarray, model: Model) -> tuple:
    """tokens, best score, summed excess of significant segments, and those segments."""
    found = segments(scores)
    best = max((s for _, _, s in found), default=0.0)
    kept = [(a, b, s) for a, b, s in found if _excess(s, n, model) > SIGNIFICANT]
    total = sum(float(_excess(s, n, model)) for _, _, s in kept)
    spans = [
        (int(begin[a]), int(end[b - 1]), s, float(np.exp(-_excess(s, n, model)))) for a, b, s in kept
    ]
    return n, best, total, spans


def document_evidence(texts: list[str], rare: list[tuple | None], model: Model) -> Iterator[tuple]:
    """What ``_weighed`` says of each text."""
    for (keys, ranges), more in zip(token_keys(texts), rare):
        yield _weighed(keys.shape[1], model.odds(keys, more), *ranges, model)


# Of each document: where tokens of positive or unknown score are (bytes), their scores as far
# as frequent counts tell, the sums of the scores before each, and which of them are unknown.
OUTLINE = (
    "row long, tokens long, begin binary, length binary, scores binary, gaps binary, "
    "unknown binary, word array<long>, five array<long>, four array<long>"
)


def _outlines(sent: Sent, columns: list[str]):
    def run(batches_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, row = sent.open(), TaskContext.get().partitionId() << 40
        names = [c.split()[0] for c in OUTLINE.split(", ")]
        for batch in batches_:
            rows = []
            for keys, (begin, end) in token_keys(list(batch["text"])):
                scores, unsure = model.odds(keys), model.unsure(keys)
                at = np.flatnonzero((scores > 0) | unsure)
                sums = np.concatenate([[0.0], np.cumsum(scores)])
                unknown = np.flatnonzero(unsure[at])
                rows.append((
                    row, len(scores), begin[at].tobytes(), (end - begin)[at].tobytes(), scores[at].tobytes(),
                    (sums[at] - np.concatenate([[0.0], sums[at[:-1] + 1]])[: len(at)]).tobytes(),
                    unknown.astype(np.int32).tobytes(), *keys[:, at[unknown]],
                ))
                row += 1
            yield batch[columns].reset_index(drop=True).join(pd.DataFrame(rows, columns=names))

    return run


def outlines(rows: DataFrame, model: Model, scratch: Scratch, name: str) -> DataFrame:
    """Other columns than the text, outlines, and the rare scores that they lack."""
    columns = [c for c in rows.columns if c != "text"]
    schema = ", ".join([f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns] + [OUTLINE])
    made = rows.mapInPandas(_outlines(model.local(rows.sparkSession), columns), schema)
    made = scratch.write(made, f"outlines-{name}")
    each = F.explode(F.array_distinct(F.arrays_zip(*NAMES))).alias("each")
    told = scratch.write(_told(made.select("row", each).select("row", "each.*"), ["row"], model), f"told-{name}")
    return made.drop("five", "four").join(told.hint("merge"), "row", "left").drop("row")


def outline_evidence(batch: pd.DataFrame, model: Model) -> Iterator[tuple]:
    """What ``_weighed`` says of each document, from its outline."""
    for r, rare in zip(batch.itertuples(), _rare_of(batch)):
        scores = np.frombuffer(r.scores).copy()
        begin, length = np.frombuffer(r.begin, np.int64), np.frombuffer(r.length, np.int64)
        if rare is not None:
            unknown, told = np.frombuffer(r.unknown, np.int32), dict(zip(*rare))
            scores[unknown] = [told.get(w, s) for w, s in zip(r.word, scores[unknown])]
        line = np.stack([np.frombuffer(r.gaps), scores], axis=1).ravel()
        yield _weighed(r.tokens, line, np.repeat(begin, 2), np.repeat(begin + length, 2), model)


def _features(tokens: np.ndarray, best: np.ndarray, total: np.ndarray, model: Model) -> np.ndarray:
    excess = np.clip(_excess(best, tokens, model), -12, 40) / 6
    return np.column_stack([excess, np.log1p(total)])


def _histogram(sent: "Sent", edges: np.ndarray):
    def run(batches_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.open()
        counts = np.zeros(len(edges) - 1, np.int64)
        for batch in batches_:
            for (keys, _), more in zip(token_keys(list(batch["text"])), _rare_of(batch)):
                values = np.clip(model.odds(keys, more), edges[0], edges[-1])
                counts += np.histogram(values, edges)[0]
        yield pd.DataFrame({"bin": np.arange(len(counts)), "n": counts})

    return run


def _evidence(sent: Sent):
    def run(batches_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.open()
        for batch in batches_:
            rows = [e[:3] for e in document_evidence(list(batch["text"]), _rare_of(batch), model)]
            frame = pd.DataFrame(rows, columns=["tokens", "best", "total"])
            yield batch[["doc_id", "toxic"]].reset_index(drop=True).join(frame)

    return run


def _root(counts: np.ndarray, values: np.ndarray) -> float:
    """The positive lambda at which exp(lambda s) is 1 on average."""
    shares = counts / counts.sum()
    low, high = 1e-3, 20.0
    if (shares * values).sum() >= 0 or not shares[values > 0].any():
        return 1.0
    for _ in range(60):
        middle = (low + high) / 2
        if (shares * np.exp(np.minimum(middle * values, 500))).sum() > 1:
            high = middle
        else:
            low = middle
    return middle


def _frequent(sums: DataFrame) -> Model:
    """A model with the counts of the frequent tokens, at most HEAD."""
    n = F.col("toxic") + F.col("clean")
    totals = sums.where("kind = 0").agg(F.sum("toxic"), F.sum("clean")).first()
    sizes = sums.groupBy(F.floor(F.log2(n) + 1e-9).cast("int").alias("power")).count().collect()
    sizes = {r["power"]: r["count"] for r in sizes}  # at most a row a power of two
    power = max(sizes, default=0) + 1
    room = HEAD
    while power > 0 and sizes.get(power - 1, 0) <= room:
        power -= 1
        room -= sizes.get(power, 0)
    head = sums.where(n >= (1 << power)).orderBy("kind", "key").toArrow()
    kind, key, toxic, clean = (np.asarray(head.column(c)) for c in ("kind", "key", "toxic", "clean"))
    bounds = np.searchsorted(kind, np.arange(len(NAMES) + 1)).tolist()
    return Model(
        key, bounds, toxic.astype(float), clean.astype(float), np.array([totals[0] or 0, totals[1] or 0], float),
        sums if power else None, 1 << power, rare=_filter(sums.where(n < (1 << power))) if power else None,
    )


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled documents that are not held out.

    Three of their four folds are counted, the fourth calibrates. Counts, the histogram of
    clean scores and the moments for K cover all those rows; the last fit, of three
    numbers, takes at most ``FIT_ROWS`` rows, in the order of a hash of their id. Null
    labels are ignored; of repeated labels of an id the largest counts.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), plain_text().alias("text"))
    rows = rows.withColumn("fold", fold(F.col("doc_id"))).where("fold <> 0")
    # Spark measures the labels (two numbers a row): it broadcasts them while they are below
    # its threshold, so that no text is shuffled, and shuffles both sides beyond it.
    rows = scratch.write(rows.join(known, "doc_id"), "labelled")
    counted = rows.where("fold <> 4").select("toxic", "text")
    sums = scratch.write(
        counted.mapInPandas(_counts, TOKEN_COUNTS).groupBy("kind", "key")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "counts",
    )
    model = _frequent(sums)

    rest = rows.where("fold = 4")
    if model.counts is not None:
        rest = scratch.write(with_rare(rest, model, scratch, "fit"), "rest")
    else:
        rest = with_rare(rest, model, scratch, "fit")
    edges = np.linspace(-15, 15, 1201)
    bins = (
        rest.where("toxic = 0").select("text", "_rare_words", "_rare_scores")
        .mapInPandas(_histogram(model.local(docs.sparkSession), edges), "bin int, n long")
        .groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    )
    counts = np.zeros(len(edges) - 1)
    counts[bins["bin"].to_numpy(int)] = bins["n"].to_numpy(float)
    if not counts.sum():
        return model
    model.lam = _root(counts, (edges[1:] + edges[:-1]) / 2)
    seen = scratch.write(rest.mapInPandas(_evidence(model.local(docs.sparkSession)), EVIDENCE), "first")
    means = seen.where("toxic = 0 AND tokens > 0").agg(
        F.avg("best"), F.avg(F.log("tokens"))
    ).first()
    model.log_k = model.lam * (means[0] or 0.0) - (means[1] or 0.0) - 0.5772
    seen = scratch.write(rest.mapInPandas(_evidence(model.local(docs.sparkSession)), EVIDENCE), "second")
    sample = seen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS).toPandas()
    x = _features(*(sample[c].to_numpy(float) for c in ("tokens", "best", "total")), model)
    model.weights = fit_logistic(x, sample["toxic"].to_numpy(float), ridge=0.01)
    for name in ("labelled", "rare-fit", "rest", "first", "second"):  # the counts stay
        scratch.drop(name)
    return model


SCORES = (
    "doc_id long, held_out boolean, score double, predicted int, tokens long, "
    "passages array<struct<begin:long,end:long,score:double,expected:double>>"
)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Per document its toxicity and its significant passages.

    Scores come from texts alone. A text without tokens, empty or null, gets the score of
    no evidence. Passages are byte ranges of the text in lower case, with their score and
    how many such were expected by chance. Repeated rows are scored like others, further
    columns are ignored, and an empty table gives an empty result.
    """
    key = F.col("doc_id").cast("long")
    rows = docs.select(
        key.alias("doc_id"), (fold(key) == 0).alias("held_out"), plain_text().alias("text")
    )
    return _scored(rows, model, "score", SCORES)


def _scored(rows: DataFrame, model: Model, name: str, schema: str) -> DataFrame:
    """The columns of the schema: those that rows have, and what the model says of their text."""
    columns = [c for c in rows.columns if c != "text"]
    sent, whole = model.local(rows.sparkSession), model.counts is None

    def run(batches_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.open()
        for batch in batches_:
            if whole:
                told = list(document_evidence(list(batch["text"]), [None] * len(batch), model))
            else:
                told = list(outline_evidence(batch, model))
            table = np.array([r[:3] for r in told], float).reshape(-1, 3)
            score = sigmoid(model.weights[0] + _features(*table.T, model) @ model.weights[1:])
            out = batch[columns].reset_index(drop=True).assign(
                score=score, predicted=(score >= 0.5).astype(np.int32), tokens=table[:, 0].astype(np.int64),
            )
            out["passages"] = [[dict(zip(("begin", "end", "score", "expected"), s)) for s in r[3]] for r in told]
            if "doc_id" in columns:
                out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    if not whole:
        rows = outlines(rows, model, Scratch(rows.sparkSession, "toxicity"), name)
    return rows.mapInPandas(run, schema)


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns, without those that the model takes for toxic.

    Null and empty texts stay. Equal texts are judged alike, so toxic ones are known by two
    hashes of the text; ``_text_a`` and ``_text_b`` are reserved names.
    """
    rows = docs.withColumns({
        "_text_a": F.xxhash64(plain_text()), "_text_b": F.xxhash64(F.lit(1), plain_text())
    })
    text = ["_text_a", "_text_b"]
    schema = SCORES.replace("doc_id long, held_out boolean", "_text_a long, _text_b long")
    judged = _scored(rows.select(*text, plain_text().alias("text")), model, "filter", schema)
    scratch = Scratch(docs.sparkSession, "toxicity")
    toxic = scratch.write(judged.where("predicted = 1").select(*text).distinct(), "toxic")
    # Two numbers a toxic text: Spark measures the table and broadcasts it below its threshold.
    return rows.join(toxic, text, "left_anti").drop(*text)
