"""Packing of tokenised documents into windows by best-fit decreasing (operator 4).

Documents longer than a window are first cut into full windows; what is left, and every
shorter document, is a piece. Best fit only looks at lengths, so it runs on the histogram
of piece lengths (one row per length, at most a window's worth of rows): pieces of one
length are placed in bulk, into windows of one remaining capacity at a time. The result is
a list of steps over places in the order of falling length, and every task reads from it
where its own pieces go. The list depends on the number of lengths, not of documents.
"""

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.llm import tokens
from salesmart.llm.shared import Scratch, plain_text, shuffle_width

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, piece_id long, "
    "ids binary"
)
ROWS_AT_ONCE = 10_000


@dataclass(frozen=True)
class Windows:
    """Tokenizer file, end id and size of a window."""

    tokenizer: str
    end_id: int = 1
    size: int = 2048


class Tightest:
    """A segment tree over remaining capacities: the smallest open one that is enough."""

    def __init__(self, size: int):
        self._leaves = 1 << size.bit_length()
        self._open = [False] * (2 * self._leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        node = self._leaves + capacity
        self._open[node] = is_open
        while node > 1:
            node //= 2
            self._open[node] = self._open[2 * node] or self._open[2 * node + 1]

    def find(self, least: int) -> int | None:
        node = self._leaves + least
        while not self._open[node]:
            # Up to the first ancestor that has a right neighbour, and over to it.
            while node & 1:
                node //= 2
                if node <= 1:
                    return None
            node += 1
        while node < self._leaves:
            node = 2 * node if self._open[2 * node] else 2 * node + 1
        return node - self._leaves


def best_fit(counts: dict[int, int], size: int) -> np.ndarray:
    """Steps of best-fit decreasing for so many pieces of each length.

    Columns: first place in the order of falling length, length, first window, pieces per
    window, offset of the first piece in a window.
    """
    tree, open_windows = Tightest(size), defaultdict(deque)
    steps, place, windows = [], 0, 0

    def put(capacity: int, first: int, number: int) -> None:
        if number and capacity:
            if not open_windows[capacity]:
                tree.set(capacity, True)
            open_windows[capacity].append((first, number))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            capacity = tree.find(length)
            if capacity is None:
                capacity, first = size, windows
                number = -(-left // (size // length))
                windows += number
            else:
                first, number = open_windows[capacity].popleft()
                if not open_windows[capacity]:
                    tree.set(capacity, False)
            # A window that takes one piece is then the tightest for the next.
            each = capacity // length
            used = min(number, -(-left // each))
            placed = min(left, used * each)
            steps.append((place, length, first, each, size - capacity))
            whole, rest = divmod(placed, each)
            put(capacity - each * length, first, whole)
            put(capacity - rest * length, first + whole, 1 if rest else 0)
            put(capacity, first + used, number - used)
            place, left = place + placed, left - placed
    return np.array(steps, np.int64).reshape(-1, 5)


def cut_documents(docs: DataFrame, windows: Windows, with_ids: bool = True) -> DataFrame:
    """Pieces of at most a window of every document, with their ids or only a checksum."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, step = tokens.encoder(windows.tokenizer).encode, 4 * windows.size
        end = windows.end_id.to_bytes(4, "little")
        piece = TaskContext.get().partitionId() << 36
        rows = []

        def frame() -> pd.DataFrame:
            columns = [c.split()[0] for c in PIECES.split(", ")]
            return pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

        for batch in batches:
            for key, text in zip(batch["doc_id"], batch["text"]):
                ids = encode(text) + end
                for at in range(0, len(ids), step):
                    part = ids[at : at + step]
                    rows.append((
                        key, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, piece,
                        part if with_ids else None,
                    ))
                    piece += 1
                    if len(rows) == ROWS_AT_ONCE:
                        yield frame()
                        rows.clear()
        yield frame()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), plain_text().alias("text"))
    return rows.mapInPandas(cut, PIECES)


def place_pieces(pieces: DataFrame, size: int, scratch: Scratch) -> DataFrame:
    """``pieces`` with sequence_id and offset; ``length`` is at least 1 and at most size.

    Places in the order of falling length come from a sort by range, which splits the most
    frequent length over tasks, and from the row counts of its ranges.
    """
    ordered = (
        pieces.repartitionByRange(
            shuffle_width(pieces.sparkSession), F.col("length").desc(), "piece_id"
        )
        .sortWithinPartitions(F.col("length").desc(), "piece_id")
        .withColumn("numbered", F.monotonically_increasing_id())
    )
    ordered = scratch.write(ordered, "ordered")
    part = F.shiftright("numbered", 33)
    in_part = ordered.groupBy(part.alias("part"), "length").count()
    in_part = in_part.groupBy("part").agg(
        F.sum("count").alias("rows"), F.collect_list(F.struct("length", "count")).alias("lengths")
    ).collect()  # one row per task of the sort, at most a window's worth of lengths in all
    starts, counts, place = {}, defaultdict(int), 0
    for row in sorted(in_part, key=lambda r: r["part"]):
        starts[row["part"]], place = place, place + row["rows"]
        for length, count in row["lengths"]:
            counts[length] += count
    steps = best_fit(counts, size)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = steps[:, 0]
        for batch in batches:
            numbered = batch["numbered"].to_numpy(np.int64)
            start = np.array([starts[p] for p in numbered >> 33], np.int64)
            place = start + (numbered & ((1 << 33) - 1))
            step = steps[np.searchsorted(first, place, side="right") - 1].reshape(-1, 5)
            nth = place - step[:, 0]
            batch["sequence_id"] = step[:, 2] + nth // step[:, 3]
            batch["offset"] = step[:, 4] + nth % step[:, 3] * step[:, 1]
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            yield batch.drop(columns="numbered")

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema]
    schema = ", ".join([*fields, "sequence_id long", "`offset` long"])
    return ordered.mapInPandas(assign, schema)


def pack(docs: DataFrame, windows: Windows, with_ids: bool = True) -> DataFrame:
    """One row per piece of a document, with its sequence and its offset there.

    Null texts count as empty, and an empty text is its end id alone. Rows that repeat a
    doc_id, and rows with a null one, are documents like others. Further columns are
    ignored; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = cut_documents(docs, windows, with_ids)
    if not with_ids:
        pieces = pieces.drop("ids")
    return place_pieces(scratch.write(pieces, "pieces"), windows.size, scratch)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids, one row per sequence: the pieces' bytes in order of their offset.

    A sequence has at most as many pieces as ids, so a group is at most one window.
    """
    ids = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return packed.groupBy("sequence_id").agg(ids.alias("pieces")).select(
        "sequence_id",
        F.aggregate(
            "pieces", F.lit(b"").cast("binary"), lambda all_, p: F.concat(all_, p["ids"])
        ).alias("ids"),
        F.transform("pieces", lambda p: p["doc_id"]).alias("doc_ids"),
    )
