"""Exact join of documents by the Jaccard similarity of their word shingles (operator 9).

A join in the metric space of sets under Jaccard distance: pivots, a region around each,
documents near a border in several regions, regions joined recursively.

Documents make poor first pivots. Sets of hundreds of shingles lie at a distance of almost
1 from each other, so the triangle inequality separates nothing. The first pivots here are
therefore single shingles, in one fixed order (by hash): a document of n shingles belongs
to the regions of its first n - ceil(t n) + 1 pivots. That is its window: two documents of
similarity t or more differ in so few shingles that they share one of them.

A region with many members is a frequent passage or a large family of copies. Its shingle
moves to the end of the order, and documents move on to the pivots of their window in the
new order. So shingles of a document's own come first, and documents that have too many of them meet nobody: two documents whose first
shared shingle is in places i and j share at most min(n - i, m - j) of n and m shingles.
Pairs that this excludes are never made.

1. Regions with few members: they meet each other.
2. Regions that are still crowded have a document as their pivot, the member with the fewest
   shingles before the shared one. It meets all others. Those within reach of it make up
   one component with it and are settled among themselves.
3. Members outside the pivot's component (strays) meet the members of other components,
   unless their distances to the pivot differ by more than the join's radius (triangle
   inequality) or their places exclude it.

Every comparison starts with bounds (sizes, then counts of shingles by classes of their
hash, whose difference never exceeds that of the sets) and ends with the sets themselves.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.shared import Scratch, components, mixed, plain_text, word_hashes

CLASSES = 64  # at least; longer documents have one for about 16 shingles
MOST_CLASSES = 1 << 16
MOST_STRAYS = 64  # members beyond which a region's shingle goes to the end of the order
SPARE = 16  # pivots kept beyond one and a half of a document's windows
WHOLE = 256  # and up to so many shingles all of them
ROWS = 1000  # documents of which a task holds the sets at a time
SETS = (
    "doc_id long, mark long, node long, n long, same binary, classes binary, pivots array<long>"
)


def mark() -> Column:
    """A number by which a text is found again among those of one doc_id."""
    return F.xxhash64(plain_text())


@dataclass(frozen=True)
class Similarity:
    """Words in a shingle, and the least similarity in percent."""

    words: int = 5
    percent: int = 80

    def window(self, n: Column | int):
        """Shingles of which two similar documents share one."""
        if isinstance(n, Column):
            return n - F.ceil(n * F.lit(self.percent) / F.lit(100.0)).cast("long") + 1
        return n + (-n * self.percent // 100) + 1

    def reaches(self, n: str, place: str, m: str) -> Column:
        """Whether n shingles, of which the one in this place is the first shared with a set
        of m, leave enough for similarity."""
        left = F.col(n) - F.col(place)
        return left * (100 + self.percent) >= (F.col(n) + F.col(m)) * self.percent

    def within(self, n: str, place: str, m: str, other: str) -> Column:
        """Whether two sets may be similar whose first shared shingle is in these places."""
        sizes = F.least(n, m) * 100 >= F.greatest(n, m) * self.percent
        return sizes & self.reaches(n, place, m) & self.reaches(m, other, n)


def shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """Distinct shingles of a word sequence, ascending; a short sequence is one shingle."""
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    count = len(hashes) - width + 1
    value = np.full(count, width, np.uint64)
    for i in range(width):
        value = mixed(value + hashes[i : i + count])
    return np.unique(value)


def _texts(batch: pd.DataFrame) -> list[bytes]:
    return [t.encode() for t in batch["text"]]


def class_counts(values: np.ndarray) -> np.ndarray:
    """Shingles per class (the last bits of their hash), up to 255."""
    size = min(MOST_CLASSES, max(CLASSES, 1 << (len(values) // 16).bit_length()))
    counts = np.bincount((values & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.minimum(counts, 255).astype(np.uint8)


def class_difference(x: np.ndarray, y: np.ndarray) -> int:
    """At most the number of shingles that only one of two documents has.

    Finer classes are added up to the coarser ones; counts stop at 255 on either side, so
    what stops there can only bring the two closer.
    """
    if len(x) < len(y):
        x, y = y, x
    x = np.minimum(x.reshape(-1, len(y)).sum(axis=0, dtype=np.int64), 255)
    return int(np.abs(x - y.astype(np.int64)).sum())


def _same(values: np.ndarray) -> bytes:
    """128 bits that stand for a whole set."""
    return np.array([
        np.bitwise_xor.reduce(mixed(values)), np.add.reduce(mixed(values ^ np.uint64(0xA5A5)))
    ]).tobytes()


def _sets(similarity: Similarity):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node = TaskContext.get().partitionId() << 36
        parts = (b[i : i + ROWS] for b in batches for i in range(0, len(b), ROWS))
        for batch in parts:
            rows = []
            for key, own, hashes in zip(batch["doc_id"], batch["mark"], word_hashes(_texts(batch))):
                values = shingles(hashes, similarity.words)
                spare = max(3 * similarity.window(len(values)) // 2 + SPARE, WHOLE)
                rows.append((
                    key, own, node, len(values), _same(values),
                    class_counts(values).tobytes(),
                    values[:spare].view(np.int64),
                ))
                node += 1
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in SETS.split(", ")])
            yield frame.astype({"doc_id": "Int64"})

    return run


def _whole(similarity: Similarity):
    """Whole sets of documents whose set is known by its 128 bits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes, sets = [], []
            for node, same, hashes in zip(batch["node"], batch["same"], word_hashes(_texts(batch))):
                values = shingles(hashes, similarity.words)
                if _same(values) == same:
                    nodes.append(node)
                    sets.append(values.tobytes())
            yield pd.DataFrame({"node": nodes, "set": sets})

    return run


def _near(percent: int):
    """Pairs that their class counts do not exclude."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = zip(batch["a_classes"], batch["b_classes"])
            apart = np.array([
                class_difference(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8))
                for a, b in pairs
            ], np.int64)
            sizes = batch["a_n"].to_numpy() + batch["b_n"].to_numpy()
            # intersection >= t * union, with intersection = (sizes - apart) / 2
            keep = 100 * (sizes - apart) >= percent * (sizes + apart)
            yield batch.loc[keep, ["a", "b", "a_n", "b_n"]]

    return run


def _measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        both = [
            len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), True))
            for x, y in zip(batch["a_set"], batch["b_set"])
        ]
        yield batch[["a", "b", "a_n", "b_n"]].assign(shared=np.array(both, np.int64))


class JaccardJoin:
    """One run of the join; the result of every step is a written table."""

    def __init__(self, docs: DataFrame, similarity: Similarity):
        self.similarity = similarity
        self.scratch = Scratch(docs.sparkSession, "jaccard")
        self.texts = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), mark().alias("mark"),
            plain_text().alias("text"),
        )
        self._step = 0
        self._sets: DataFrame | None = None  # whole sets of the nodes compared so far

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        self._step += 1
        return self.scratch.write(df, f"{self._step:03d}-{name}")

    def run(self) -> DataFrame:
        """doc_id, n_shingles, component_id; a component's own number; mark of the text."""
        sets = self.scratch.write(self.texts.mapInPandas(_sets(self.similarity), SETS), "sets")
        # Equal sets are one node from here on.
        same = self._write(
            sets.where("n > 0").groupBy("same").agg(
                F.min("node").alias("node"), F.min("doc_id").alias("least_doc")
            ),
            "same",
        )
        late = self._late(sets.where("n > 0"))
        nodes = self._write(same.select("node").join(late, "node", "left"), "order")
        self.reps = self._write(sets.join(nodes, "node"), "representatives")
        docs = self._write(sets.select("doc_id", "mark", "node", "n", "same"), "documents")
        self.scratch.drop("sets")
        found = components(self._links(), self.scratch)
        whole = same.join(found, "node", "left").select(
            "same", "least_doc", F.coalesce("component", "node").alias("component")
        )
        least = whole.groupBy("component").agg(F.min("least_doc").alias("component_id"))
        labels = whole.join(least, "component").select("same", "component", "component_id")
        return docs.join(labels, "same", "left").select(
            "doc_id", F.col("n").alias("n_shingles"),
            F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
            .alias("component_id"),
            F.coalesce("component", "node").alias("component"), "mark",
        )

    def _links(self) -> DataFrame:
        """Edges (a, b) whose components are those of all links."""
        regions = self._regions(self._windows())
        crowded = F.col("members") > MOST_STRAYS
        few = regions.where(~crowded)

        def side(c: str) -> DataFrame:
            return few.select(
                "pivot", F.col("node").alias(c), F.col("n").alias(f"{c}_n"),
                F.col("place").alias(f"{c}_place"),
            )

        within = self.similarity.within
        pairs = (
            side("a").join(side("b"), "pivot").where("a < b")
            .where(within("a_n", "a_place", "b_n", "b_place")).select("a", "b")
        )
        stars = (
            regions.where(crowded & (F.col("node") != F.col("first")))
            .where(within("n", "place", "first_n", "first_place"))
            .select(F.least("node", "first").alias("a"), F.greatest("node", "first").alias("b"))
        )
        met = self._measure(pairs.union(stars))
        links = self._linked(met)
        many = regions.where(crowded)
        return links if many.isEmpty() else self._strays(many, met, links)

    def _windows(self) -> DataFrame:
        """(pivot, node, n, place) of the windows; shingles of crowded regions come last."""
        ordered = F.concat(F.array_except("pivots", "late"), F.array_intersect("pivots", "late"))
        pivots = F.when(F.col("late").isNull(), F.col("pivots")).otherwise(ordered)
        first = F.slice(pivots, F.lit(1), self._window())
        return self.reps.select("node", "n", F.posexplode(first).alias("place", "pivot"))

    def _window(self) -> Column:
        return self.similarity.window(F.col("n")).cast("int")

    def _late(self, sets: DataFrame) -> DataFrame:
        """(node, late): pivots of a node that come last, those of crowded regions and what
        else documents share whose sets are kept whole.

        Any choice gives all links, as long as it is one for all documents and what is kept
        of each fills its window; where that would fail, the rarest lose their late place.
        """
        whole = F.size("pivots") == F.col("n")
        counted = F.when(whole, F.col("pivots")).otherwise(F.slice("pivots", F.lit(1), self._window()))
        members = sets.select(F.explode(counted).alias("pivot")).groupBy("pivot").agg(
            F.count("*").alias("members")
        )
        late = self._write(members.where(F.col("members") > MOST_STRAYS), "late")
        pivots = sets.select("node", F.explode("pivots").alias("pivot"))
        hits = self._write(pivots.join(late, "pivot").select("node", "pivot", "members"), "hits")
        by_node = hits.groupBy("node").agg(F.collect_set(F.struct("members", "pivot")).alias("late"))
        kept = sets.select("node", "n", F.size("pivots").alias("kept"))
        lacking = self._window() - F.col("kept") + F.size("late")
        needed = (
            kept.where("kept < n").join(by_node, "node").where(lacking > 0)
            .select(F.explode(F.slice(F.array_sort("late"), F.lit(1), lacking)).alias("rare"))
        )
        needed = needed.select("rare.pivot").distinct()
        hits = hits.join(self._write(needed, "needed"), "pivot", "left_anti")
        return hits.groupBy("node").agg(F.collect_set("pivot").alias("late"))

    def _regions(self, rows: DataFrame) -> DataFrame:
        """Members of regions of two or more that may be similar to the least of them."""
        region = Window.partitionBy("pivot")
        least = F.min("n").over(region)
        first = F.min(F.struct("place", "n", "node")).over(region)
        rows = rows.withColumns({
            "members": F.count("*").over(region), "least": least, "first": first,
        })
        return self._write(
            rows.where("members > 1").where(self.similarity.reaches("n", "place", "least")).select(
                "pivot", "node", "n", "place", "members", F.col("first.node").alias("first"),
                F.col("first.n").alias("first_n"), F.col("first.place").alias("first_place"),
            ),
            "regions",
        )

    def _strays(self, regions: DataFrame, met: DataFrame, links: DataFrame) -> DataFrame:
        """Edges of the links so far and of those that strays of crowded regions have."""
        whole = self._write(components(links, self.scratch), "components")

        def component(column: str) -> DataFrame:
            return whole.select(
                F.col("node").alias(column), F.col("component").alias(f"{column}_component")
            )

        # How far members are from their pivot, where that was measured.
        far = met.select(
            "a", "b",
            (1 - F.col("shared") / (F.col("a_n") + F.col("b_n") - F.col("shared"))).alias("far"),
        )
        others = regions.where("node <> first").join(component("node"), "node", "left").join(
            component("first"), "first", "left"
        ).withColumns({"a": F.least("node", "first"), "b": F.greatest("node", "first")}).join(
            far, ["a", "b"], "left"
        ).select(
            "pivot", "node", "n", "place", "far",
            F.coalesce("node_component", "node").alias("component"),
            F.coalesce("first_component", "first").alias("first_component"),
        )
        others = self._write(others, "placed")

        def side(c: str) -> DataFrame:
            return others.select(
                "pivot", F.col("node").alias(c), F.col("n").alias(f"{c}_n"),
                F.col("place").alias(f"{c}_place"), F.col("component").alias(f"{c}_component"),
                F.col("far").alias(f"{c}_far"), "first_component",
            )

        radius = 1 - self.similarity.percent / 100 + 1e-9
        strays = side("x").where("x_component <> first_component").drop("first_component")
        apart = F.abs(F.col("x_far") - F.col("y_far"))
        pairs = (
            strays.join(side("y"), "pivot")
            .where("x_component <> y_component")
            .where(self.similarity.within("x_n", "x_place", "y_n", "y_place"))
            .where(F.coalesce(apart <= radius, F.lit(True)))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        )
        joined = whole.where("node <> component").select(
            F.col("component").alias("a"), F.col("node").alias("b")
        )
        return joined.union(self._linked(self._measure(pairs)))

    def _linked(self, measured: DataFrame) -> DataFrame:
        union = F.col("a_n") + F.col("b_n") - F.col("shared")
        near = F.col("shared") * 100 >= union * self.similarity.percent
        return self._write(measured.where(near).select("a", "b"), "links")

    def _measure(self, pairs: DataFrame) -> DataFrame:
        """(a, b, a_n, b_n, shared) of the pairs that no bound excludes."""

        def side(c: str) -> DataFrame:
            return self.reps.select(
                F.col("node").alias(c), F.col("n").alias(f"{c}_n"),
                F.col("classes").alias(f"{c}_classes"),
            )

        near = (
            pairs.distinct().join(side("a"), "a").join(side("b"), "b")
            .mapInPandas(_near(self.similarity.percent), "a long, b long, a_n long, b_n long")
        )
        near = self._write(near, "near")
        nodes = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        if self._sets is not None:
            nodes = nodes.join(self._sets, "node", "left_anti")
        nodes = self._write(self.reps.select("node", "doc_id", "mark", "same").join(nodes, "node"), "nodes")
        if not nodes.isEmpty():
            new = self._whole_sets(nodes)
            self._sets = new if self._sets is None else self._sets.union(new)
        if self._sets is None:
            return near.withColumn("shared", F.lit(0).cast("long"))
        sets = self._sets
        both = near.join(sets.select(F.col("node").alias("a"), F.col("set").alias("a_set")), "a")
        both = both.join(sets.select(F.col("node").alias("b"), F.col("set").alias("b_set")), "b")
        return self._write(
            both.mapInPandas(_measured, "a long, b long, a_n long, b_n long, shared long"),
            "measured",
        )

    def _whole_sets(self, nodes: DataFrame) -> DataFrame:
        """(node, set), from the texts of a few documents."""
        wanted = nodes.select(F.col("doc_id").alias("id"), F.col("mark").alias("own"), "node", "same")
        # Candidates grow with the documents: they are not for broadcasting.
        same_row = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("own"))
        rows = self.texts.join(wanted.hint("merge"), same_row).select("node", "same", "text")
        sets = rows.mapInPandas(_whole(self.similarity), "node long, set binary")
        return self._write(sets.dropDuplicates(["node"]), "sets")


def jaccard_components(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """Per document the size of its shingle set and the smallest doc_id linked with it.

    Documents without words, empty or null texts have an empty set and are linked with
    nothing. Rows that repeat a doc_id are documents of their own; a null doc_id counts as
    larger than all, so component_id is null only where no other is linked. Further columns
    are ignored; an empty table gives an empty result. ``component`` is a number of the
    component that is never null, ``mark`` a hash of the text.
    """
    return JaccardJoin(docs, similarity).run()


def one_of_each(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """The documents, one of each group of linked ones.

    The row of the smallest doc_id stays (a null one counts as larger than all); of rows
    with that id the one with the smallest hash of its text, and of rows alike in both
    one. Documents without words all stay. Columns stay as they are; ``_mark`` and
    ``_times`` are reserved names.
    """
    found = jaccard_components(docs, similarity)
    place = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "mark")
    kept = found.where("n_shingles > 0").groupBy("component").agg(F.min(place).alias("p"))
    kept = kept.select("p.doc_id", "p.mark").withColumn("alone", F.lit(True))
    empty = found.where("n_shingles = 0").select("doc_id", "mark").distinct()
    times = found.groupBy("doc_id", "mark").agg(F.count("*").alias("times"))

    def same(other: DataFrame):
        return times["doc_id"].eqNullSafe(other["doc_id"]) & (times["mark"] == other["mark"])

    kept = times.join(kept, same(kept)).select(times["doc_id"], times["mark"], "times").union(
        times.join(empty, same(empty)).select(
            times["doc_id"], times["mark"], F.lit(1).cast("long").alias("times")
        )
    ).select(F.col("doc_id").alias("_id"), F.col("mark").alias("_same"), F.col("times").alias("_times"))
    rows = docs.withColumn("_mark", mark()).join(
        kept.hint("merge"), F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_same"))
    )
    once = rows.where("_times = 1")
    repeated = rows.where("_times > 1").dropDuplicates(["_id", "_mark"])
    return once.union(repeated).select(*docs.columns)
