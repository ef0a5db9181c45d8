"""Quality of documents by co-training of two views (operator 5).

One classifier sees the text: how character classes follow each other, and how often
words and lines repeat. The other sees what is known of the page without its text:
language, source, both together, and the stored number of characters. In every round each
view labels, for the other, the unlabelled documents of which it is surest. At the end each
view is calibrated on labelled documents that it did not learn from, the two are combined,
and every document is scored.

All unlabelled documents take part. Their features are a written table; a round passes
over it twice: a histogram of margins gives the two thresholds of each view, then what lies
beyond them is taken. What earlier rounds took is known from their thresholds, so nothing
is marked. A fit takes bounded samples, in the order of a hash of doc_id: at most
``labelled_rows`` labelled documents and ``taught_rows`` of each round's pseudo-labels.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.logistic import fit_logistic, sigmoid
from salesmart.llm.shared import WHITE, Rolling, Scratch, plain_text, stretches
from salesmart.llm.toxicity import fold

# Classes of bytes: lower, upper, digit, space, line end, sentence marks, quotes and
# brackets, other signs, parts of other letters.
CLASSES = 9
_CLASS = np.full(256, 7, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[list(b" \t\r\x0b\x0c")] = 3
_CLASS[10] = 4
_CLASS[list(b".,;:!?")] = 5
_CLASS[list(b"'\"()[]-")] = 6
_CLASS[128:] = 8
CONTENT = CLASSES * CLASSES + 4
META_HASHES = 64
META = META_HASHES + 3
# Margins are counted in steps of 1 / STEPS between -REACH and REACH.
STEPS, REACH = 64, 32


@dataclass(frozen=True)
class Training:
    """Bounds of the samples that are fitted, rounds, and share of the pool taken in a round."""

    labelled_rows: int = 20_000
    taught_rows: int = 10_000
    rounds: int = 5
    share: float = 0.04


@dataclass
class View:
    """Standardised features and the weights found for them."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.weights[0] + ((x - self.mean) / self.scale) @ self.weights[1:]


@dataclass
class Model:
    content: View
    page: View
    combine: np.ndarray

    def probability(self, content: np.ndarray, page: np.ndarray) -> np.ndarray:
        margins = np.column_stack([self.content.margin(content), self.page.margin(page)])
        return sigmoid(self.combine[0] + np.clip(margins, -12, 12) @ self.combine[1:])


def content_features(text: bytes) -> np.ndarray:
    """Shares of pairs of character classes; repetition of words and of lines."""
    data = np.frombuffer(text, np.uint8)
    out = np.zeros(CONTENT)
    if not len(data):
        return out
    kind = _CLASS[data]
    pairs = np.bincount(kind[:-1] * CLASSES + kind[1:], minlength=CLASSES * CLASSES)
    out[: CLASSES * CLASSES] = np.log1p(1000 * pairs / len(data))
    begin, end = stretches(~WHITE[data])
    rolling = Rolling(data)
    words = rolling.hashes(begin, end)
    if len(words):
        distinct, counts = np.unique(words, return_counts=True)
        out[-4] = len(distinct) / len(words)
        out[-3] = counts.max() / len(words)
        # Words that repeat the one before.
        out[-2] = (words[1:] == words[:-1]).mean() if len(words) > 1 else 0
    begin, end = stretches(data != 10)
    lines = rolling.hashes(begin, end)
    out[-1] = len(np.unique(lines)) / max(len(lines), 1)
    return out


def page_features(lang: str | None, source: str | None, n_chars: float | None) -> np.ndarray:
    """Language, source and their pair by hash; the stored length, and whether there is one."""
    out = np.zeros(META)
    for name in (f"lang {lang}", f"source {source}", f"pair {lang} {source}"):
        value = np.frombuffer(name.encode(), np.uint8)
        place = Rolling(value).hashes(np.array([0]), np.array([len(value)]))[0]
        out[int(place % np.uint64(META_HASHES))] += 1
    known = n_chars is not None and np.isfinite(n_chars)
    length = np.log1p(max(float(n_chars), 0.0)) if known else 0.0
    out[META_HASHES:] = length, length * length / 10, float(known)
    return out


def _features(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    content = np.array([content_features(t.encode()) for t in batch["text"]]).reshape(-1, CONTENT)
    rows = zip(batch["lang"], batch["source"], batch["n_chars"])
    return content, np.array([page_features(*r) for r in rows]).reshape(-1, META)


def _collected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        content, page = _features(batch)
        yield pd.DataFrame({
            "doc_id": batch["doc_id"], "fold": batch["fold"], "h": batch["h"],
            "content": [r.astype("<f4").tobytes() for r in content],
            "page": [r.astype("<f4").tobytes() for r in page],
        })


def _unpacked(rows: pd.DataFrame) -> list[np.ndarray]:
    """The two views' features of collected rows."""
    return [
        np.frombuffer(b"".join(rows[c]), "<f4").reshape(len(rows), size).astype(float)
        for c, size in (("content", CONTENT), ("page", META))
    ]


def _view(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> View:
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 0.05)
    return View(mean, scale, fit_logistic((x - mean) / scale, y, weight, ridge=2.0))


@dataclass
class Rule:
    """The views of one round, and the steps of margin from which each takes documents."""

    views: list[View]
    low: list[int]
    high: list[int]

    def taken(self, views: list[np.ndarray]) -> np.ndarray:
        """For each view and row 0 or 1, the label it gives, or -1."""
        out = np.full((2, len(views[0])), -1)
        for v in range(2):
            step = _steps(self.views[v], views[v])
            out[v][step <= self.low[v]] = 0
            out[v][step >= self.high[v]] = 1
        return out


def _steps(view: View, x: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(view.margin(x), -REACH, REACH) * STEPS).astype(np.int64)


def _free(rules: list[Rule], views: list[np.ndarray]) -> np.ndarray:
    """Which rows no rule has taken yet."""
    free = np.ones(len(views[0]), bool)
    for rule in rules:
        free &= (rule.taken(views) < 0).all(axis=0)
    return free


def margin_counts(views: list[np.ndarray], rules: list[Rule], models: list[View]) -> np.ndarray:
    """Rows that are free by step of margin, for both views."""
    free = _free(rules, views)
    steps = [_steps(models[v], views[v][free]) + REACH * STEPS for v in range(2)]
    return np.array([np.bincount(s, minlength=2 * REACH * STEPS + 1) for s in steps])


def picks(views: list[np.ndarray], rules: list[Rule]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, view and label of what the last rule takes of what the earlier ones left."""
    taken = rules[-1].taken(views)
    taken[:, ~_free(rules[:-1], views)] = -1
    view, row = np.nonzero(taken >= 0)
    return row, view, taken[view, row]


def thresholds(counts: np.ndarray, low_size: float, high_size: float, base: float) -> tuple[int, int]:
    """Steps that cut the given numbers of rows off both ends; a step is taken whole.

    Only margins beyond 1, and more than 1 beyond what the share of good labels alone says,
    are sure enough: a view that knows nothing teaches nothing.
    """
    prior = float(np.log(np.clip(base, 1e-6, 1 - 1e-6) / np.clip(1 - base, 1e-6, 1)))
    steps = np.arange(len(counts)) - REACH * STEPS
    below, above = np.cumsum(counts) - counts, np.cumsum(counts[::-1])[::-1] - counts
    low = steps[(below < low_size) & (steps < min(-1.0, prior - 1) * STEPS)]
    high = steps[(above < high_size) & (steps > max(1.0, prior + 1) * STEPS)]
    return int(low.max(initial=-REACH * STEPS - 1)), int(high.min(initial=REACH * STEPS + 1))


class ArrayPool:
    """An unlabelled pool in two arrays."""

    def __init__(self, content: np.ndarray, page: np.ndarray):
        self.views, self.size = [content, page], len(content)

    def counts(self, rules: list[Rule], models: list[View]) -> np.ndarray:
        return margin_counts(self.views, rules, models)

    def picked(self, rules: list[Rule], total: int, limit: int):
        """Features of both views, view and label of the rows that the last rule takes."""
        row, view, label = (a[:limit] for a in picks(self.views, rules))
        return [x[row] for x in self.views], view, label


class TablePool:
    """An unlabelled pool in a table (h, content, page); tasks return counts and picks."""

    def __init__(self, rows: DataFrame):
        self.rows, self.size = rows, rows.count()

    def counts(self, rules: list[Rule], models: list[View]) -> np.ndarray:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            counts = np.zeros((2, 2 * REACH * STEPS + 1), np.int64)
            for batch in batches:
                counts += margin_counts(_unpacked(batch), rules, models)
            view, step = np.nonzero(counts)
            yield pd.DataFrame({"view": view, "step": step, "n": counts[view, step]})

        found = self.rows.select("content", "page").mapInPandas(run, "view int, step int, n long")
        out = np.zeros((2, 2 * REACH * STEPS + 1), np.int64)
        for r in found.groupBy("view", "step").agg(F.sum("n").alias("n")).collect():
            out[r.view, r.step] = r.n
        return out

    def picked(self, rules: list[Rule], total: int, limit: int):
        """As of arrays; if there are more than ``limit``, those of the smallest hashes."""
        # About twice as many as are wanted leave the tasks.
        share = 2.0 * limit / max(total, 1)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                batch = batch[(batch["h"] + 2.0**63) / 2.0**64 <= share].reset_index(drop=True)
                row, view, label = picks(_unpacked(batch), rules)
                yield batch.iloc[row].assign(view=view, label=label)

        found = self.rows.mapInPandas(
            run, "h long, content binary, page binary, view int, label int"
        ).orderBy("h", "view", "label").limit(limit).toPandas()
        return _unpacked(found), found["view"].to_numpy(int), found["label"].to_numpy(int)


def co_train_pool(
    views: list[np.ndarray], y: np.ndarray, held: np.ndarray, pool: ArrayPool | TablePool,
    training: Training,
) -> Model:
    """The rounds: fit both views, cut the sure ends off the pool, teach the other view."""
    base = y[~held].mean() if (~held).any() else 0.5
    taught: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]
    rules: list[Rule] = []
    while True:
        models = []
        for v in range(2):
            x = np.concatenate([views[v][~held], *[x for x, _ in taught[v]]])
            labels = np.concatenate([y[~held], *[k for _, k in taught[v]]])
            # What the other view believes counts half of what a label says.
            weight = np.where(np.arange(len(x)) < (~held).sum(), 1.0, 0.5)
            models.append(_view(x, labels, weight))
        if len(rules) == training.rounds or not pool.size:
            break
        counts = pool.counts(rules, models)
        size = max(1.0, training.share * pool.size)
        low, high = zip(*(thresholds(c, size * (1 - base), size * base, base) for c in counts))
        rules.append(Rule(models, list(low), list(high)))
        steps = np.arange(counts.shape[1]) - REACH * STEPS
        total = sum(int(counts[v][(steps <= low[v]) | (steps >= high[v])].sum()) for v in range(2))
        if not total:
            break
        found, view, label = pool.picked(rules, total, training.taught_rows)
        for v in range(2):
            taught[1 - v].append((found[1 - v][view == v], label[view == v].astype(float)))
    margins = np.column_stack([models[v].margin(views[v][held]) for v in range(2)])
    combine = fit_logistic(np.clip(margins, -12, 12), y[held], ridge=0.1)
    return Model(models[0], models[1], combine)


def co_train(
    content: np.ndarray, page: np.ndarray, y: np.ndarray, held: np.ndarray,
    pool_content: np.ndarray, pool_page: np.ndarray, training: Training,
) -> Model:
    """Co-training on arrays; ``held`` rows calibrate and teach nothing."""
    return co_train_pool([content, page], y, held, ArrayPool(pool_content, pool_page), training)


def _inputs(docs: DataFrame) -> DataFrame:
    """doc_id, fold, and what the two views see; a table may lack n_chars."""
    stored = F.expr("try_cast(n_chars AS double)") if "n_chars" in docs.columns else F.lit(None)
    key = F.col("doc_id").cast("long")
    return docs.select(
        key.alias("doc_id"), fold(key).cast("int").alias("fold"), "lang", "source",
        stored.cast("double").alias("n_chars"), plain_text().alias("text"),
    )


def fit(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> Model:
    """Learn from labelled documents outside fold 0 (fold 4 calibrates) and all unlabelled ones.

    Null labels are ignored; of repeated labels of one id the smallest counts. Documents of
    fold 0, null ids among them, teach nothing. Without labels of both kinds every document
    gets the same probability.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.min("quality").cast("int").alias("quality"))
    order = F.xxhash64("doc_id")
    # Features are a fraction of a text's bytes: they are joined with the labels, not texts.
    features = scratch.write(
        _inputs(docs).where("fold <> 0").withColumn("h", order).mapInPandas(
            _collected, "doc_id long, fold int, h long, content binary, page binary"
        ),
        "features",
    )
    picked = known.where(fold(F.col("doc_id")) != 0).orderBy(order, "doc_id").limit(
        training.labelled_rows
    )
    sample = features.join(F.broadcast(picked), "doc_id").orderBy("h", "content", "page").limit(
        training.labelled_rows  # rows may repeat an id
    ).toPandas()
    views, y = _unpacked(sample), sample["quality"].to_numpy(float)
    held = sample["fold"].to_numpy() == 4
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        scratch.drop("features")
        flat = [View(np.zeros(n), np.ones(n), np.zeros(n + 1)) for n in (CONTENT, META)]
        return Model(*flat, np.array([2.0, 0.0, 0.0]))
    pool = scratch.write(
        features.join(known.select("doc_id"), "doc_id", "left_anti").select("h", "content", "page"),
        "pool",
    )
    scratch.drop("features")
    model = co_train_pool(views, y, held, TablePool(pool), training)
    scratch.drop("pool")
    return model


def score_documents(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """doc_id, held_out, the two views' margins, score, and kept: score at least ``least``.

    Null texts count as empty, null languages and sources as values of their own, a null or
    missing n_chars as unknown; long texts are read whole, one at a time. Rows that repeat a
    doc_id are scored like others; further columns are ignored. An empty table gives an
    empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            content, page = _features(batch)
            score = model.probability(content, page)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"],
                "content_margin": model.content.margin(content),
                "page_margin": model.page.margin(page), "score": score, "kept": score >= least,
            })

    rows = _inputs(docs).withColumn("held_out", F.col("fold") == 0).drop("fold")
    return rows.mapInPandas(
        run,
        "doc_id long, held_out boolean, content_margin double, page_margin double, "
        "score double, kept boolean",
    )
