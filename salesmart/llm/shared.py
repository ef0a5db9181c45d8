"""Helpers of this subpackage: input tables, intermediate tables, word hashes of texts.

Intermediate results are written as Parquet below the folder that the cluster names in
``spark.checkpoint.dir``. A written table has no lineage, so a lost executor costs the
tasks that ran on it and nothing before the table.
"""

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Scratch:
    """A folder of intermediate tables of one run, in the shared folder of the cluster.

    Only where ``spark.checkpoint.dir`` is unset and the master is local is a folder of
    this machine used. Tables stay until ``drop`` or until the folder is emptied, since a
    result that is read from them is evaluated later.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            base = f"file://{tempfile.gettempdir()}/checkpoints"
        self.folder = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """The same rows, read back from a written table."""
        path = self.path(name)
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def plain_text(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


# Words of texts as numbers ---------------------------------------------------------------

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values spread over all bits (the finisher of the SplitMix generator)."""
    x = x + _GOLDEN
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


_BASE = np.uint64(0xD6E8FEB86659FD93)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = mixed(np.arange(256, dtype=np.uint64))
_POWERS = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, n.bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


class Rolling:
    """Hashes of any stretches of a byte array in one step, from running sums."""

    def __init__(self, data: np.ndarray):
        up, self._down = _powers(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self._sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self._sums[end] - self._sums[start]) * self._down[start]
        return mixed(value ^ (end - start).astype(np.uint64))

    def grams(self, length: int) -> np.ndarray:
        """Hashes of all stretches of one length, equal to those of ``hashes``."""
        value = self._sums[length:] - self._sums[:-length]
        value *= self._down[: len(value)]
        value ^= np.uint64(length)
        return mixed(value)


def row_hashes(table: np.ndarray, length: int) -> np.ndarray:
    """Hashes of every stretch of ``length`` bytes in each row of a table of bytes."""
    up, down = _powers(table.shape[1] + 1)
    sums = np.zeros((len(table), table.shape[1] + 1), np.uint64)
    np.cumsum(_BYTE[table] * up[: table.shape[1]], axis=1, out=sums[:, 1:])
    value = sums[:, length:] - sums[:, :-length]
    return mixed(value * down[: value.shape[1]])


def stretches(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


# Bytes of text turned into arrays at a time: bounds the memory of a task.
PIECE_BYTES = 1 << 20


def batches(texts: list[bytes], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of texts that together have at most ``limit`` bytes, or of one text."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


# A-Z to a-z on bytes; others, and all bytes of other letters, stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WHITE = byte_table(b" \t\n\x0b\x0c\r")


def _cut(text: bytes, limit: int) -> Iterator[bytes]:
    """Pieces of a text of about ``limit`` bytes, cut at white space."""
    at = 0
    while len(text) - at > limit:
        end = at + limit
        while end < len(text) and not WHITE[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def word_hashes(texts: list[bytes], limit: int = PIECE_BYTES) -> Iterator[np.ndarray]:
    """For each text the 64-bit hashes of its words (runs without white space, A-Z as a-z).

    Short texts share one pass over arrays, long ones take several, so that memory follows
    the limit and eight bytes a word, not the longest text.
    """
    for first, last in batches(texts, limit):
        if last - first == 1 and len(texts[first]) > limit:
            parts = [next(word_hashes([p], 2 * limit + len(p))) for p in _cut(texts[first], limit)]
            yield np.concatenate(parts)
            continue
        group = texts[first:last]
        data = LOWER[np.frombuffer(b" ".join(group), np.uint8)]
        begin, end = stretches(~WHITE[data])
        hashes = Rolling(data).hashes(begin, end)
        starts = np.cumsum([0, *[len(t) + 1 for t in group]])
        bounds = np.searchsorted(begin, starts)
        for i in range(len(group)):
            yield hashes[bounds[i] : bounds[i + 1]]


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): connected nodes and the smallest node of their component.

    Edges (a, b) are rewired towards smallest neighbours, alternately from each node's
    larger and smaller side, until every node points at its smallest one. Each round is
    an aggregation and a join, both of them fit for a node with most of the edges.
    """
    seen, state, number = None, edges.where("a <> b").distinct(), 0
    while True:
        state = scratch.write(state, f"edges{number}")
        mark = state.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")
        ).first()
        if mark == seen:
            break
        seen, number = mark, number + 1
        both = state.select("a", "b").union(state.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.where("a <> b").distinct()
        down = down.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a")
        state = (
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
    inner = state.groupBy("a").agg(F.min("b").alias("component"))
    roots = inner.select(F.col("component").alias("node")).distinct()
    return inner.withColumnRenamed("a", "node").union(roots.select("node", F.col("node")))
