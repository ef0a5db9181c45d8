"""Tokens of two tokenizers aligned by the byte offsets where both end (operator 13).

1. A map over texts: both id lists, their cumulative ends as dictionaries from end to
   index, and the sorted intersection of the keys. Each shared end closes a group of either
   list, and links the tokens of the group that end there. A document leaves its groups'
   digest and its linked id pairs with their numbers, a few bytes a pair.
2. Pairs are counted over the corpus, and for each id of B the highest count is found.
3. The counts go back to the documents. The most frequent pairs, a fixed number of them,
   are sent to every task and settle most links where they lie. Only links of rarer pairs
   are shuffled to meet their counts.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from salesmart.llm.shared import Scratch, plain_text
from salesmart.llm.tokens import BYTE_WORDS, byte_letters

BLOCK = 1 << 16  # tokens of a document put into dictionaries at a time
HEAD = 1 << 19  # pairs every task knows the counts of
HELD = 1 << 20  # pairs a task counts before it passes them on
DIGEST = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
)


@dataclass(frozen=True)
class Tokenizers:
    """A byte-level file of the tokenizers library (A) and a sentencepiece file (B)."""

    a: str
    b: str

    def open(self) -> "Pair":
        if self not in _OPEN:
            _OPEN[self] = Pair(self)
        return _OPEN[self]


class Entries:
    """The bytes of a vocabulary's ids, in arrays."""

    def __init__(self, entries: list[bytes]):
        if not all(entries):
            raise ValueError("a token without bytes")
        self.lengths = np.array([len(e) for e in entries])
        self._starts = np.cumsum(self.lengths) - self.lengths
        self._bytes = np.frombuffer(b"".join(entries), np.uint8)

    def spell(self, ids: np.ndarray, ends: np.ndarray, text: bytes) -> bool:
        """Whether the ids, each ending where ``ends`` says, are the bytes of the text."""
        if not len(ids) or ends[-1] != len(text):
            return False
        lengths = self.lengths[ids]
        places = np.repeat(self._starts[ids] - (ends - lengths), lengths) + np.arange(len(text))
        return self._bytes[places].tobytes() == text


class Pair:
    def __init__(self, files: Tokenizers):
        whole = Tokenizer.from_file(files.a)
        special = {t.content for t in whole.get_added_tokens_decoder().values()}
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        entries = {
            i: w.encode() if w in special else bytes(byte[c] for c in w)
            for w, i in whole.get_vocab().items()
        }
        # Merges of the file stand in the order of the ids they make, which tiktoken follows.
        ranks = {entries[i]: i for w, i in whole.get_vocab().items() if w not in special}
        self._a = tiktoken.Encoding("a", pat_str=BYTE_WORDS, mergeable_ranks=ranks, special_tokens={})
        self.a = Entries([entries[i] for i in range(len(entries))])
        self._b = SentencePieceProcessor(model_file=files.b)
        self.b = Entries([self._piece(i) for i in range(self._b.get_piece_size())])
        self.n_b = self._b.get_piece_size()
        # Ids in decimal: digits to the left, and how many.
        names = [str(i) for i in range(max(len(entries), self.n_b))]
        self._digits = np.array(names, "S").view(np.uint8).reshape(len(names), -1)
        self._width = np.array([len(n) for n in names])

    def _piece(self, i: int) -> bytes:
        entry = self._b.id_to_piece(i)
        return bytes([int(entry[3:5], 16)]) if self._b.is_byte(i) else entry.replace("\u2581", " ").encode()

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        a = self._a.encode_to_numpy(" " + text, disallowed_special=())
        return a.astype(np.int64), np.array(self._b.encode(text), np.int64)

    def _stops(self, ends_a: np.ndarray, ends_b: np.ndarray) -> Iterator[tuple[list[int], list[int]]]:
        """Where groups end in either list, block by block."""
        from_a, from_b, width = 0, 0, BLOCK
        while from_a < len(ends_a):
            to_a = min(from_a + width, len(ends_a))
            to_b = int(np.searchsorted(ends_b, ends_a[to_a - 1], "right"))
            at_a = dict(zip(ends_a[from_a:to_a].tolist(), range(from_a + 1, to_a + 1)))
            at_b = dict(zip(ends_b[from_b:to_b].tolist(), range(from_b + 1, to_b + 1)))
            shared = sorted(at_a.keys() & at_b.keys())
            if not shared:  # a group of more than a block
                width *= 2
                continue
            yield list(map(at_a.__getitem__, shared)), list(map(at_b.__getitem__, shared))
            from_a, from_b, width = at_a[shared[-1]], at_b[shared[-1]], BLOCK

    def _told(self, a: np.ndarray, b: np.ndarray, stops_a: np.ndarray, stops_b: np.ndarray) -> bytes:
        """Slices as ``a1,a2|b1;...``: of each group the ids of A, then those of B."""
        sizes_a, sizes_b = np.diff(stops_a, prepend=0), np.diff(stops_b, prepend=0)
        place_a = np.arange(len(a)) + np.repeat(stops_b - sizes_b, sizes_a)
        place_b = np.arange(len(b)) + np.repeat(stops_a, sizes_b)
        ids = np.empty(len(a) + len(b), np.int64)
        ids[place_a], ids[place_b] = a, b
        mark = np.full(len(ids), ord(","), np.uint8)
        mark[place_a[stops_a - 1]], mark[place_b[stops_b - 1]] = ord("|"), ord(";")
        width = self._width[ids]
        table = np.zeros((len(ids), self._digits.shape[1] + 1), np.uint8)
        table[:, :-1] = self._digits[ids]
        table[np.arange(len(ids)), width] = mark
        return table[table > 0].tobytes()

    def groups(self, text: str) -> tuple[int, int, str, np.ndarray] | None:
        """Tokens of either side, digest of the groups and the linked pair of each group.

        None where one of the lists does not spell a space and the text.
        """
        if not text:
            return None
        (a, b), spelled = self.ids(text), b" " + text.encode()
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        if not (self.a.spell(a, ends_a, spelled) and self.b.spell(b, ends_b, spelled)):
            return None
        sha, linked, i, k, held = hashlib.sha256(), [], 0, 0, b""
        for stops_a, stops_b in map(lambda s: map(np.array, s), self._stops(ends_a, ends_b)):
            of_a, of_b = a[i : stops_a[-1]], b[k : stops_b[-1]]
            sha.update(held)
            held = self._told(of_a, of_b, stops_a - i, stops_b - k)
            # Tokens have bytes, so of a slice only the last of either side end together.
            linked.append(a[stops_a - 1] * self.n_b + b[stops_b - 1])
            i, k = stops_a[-1], stops_b[-1]
        sha.update(held[:-1])
        return len(a), len(b), sha.hexdigest(), np.concatenate(linked)


_OPEN: dict[Tokenizers, Pair] = {}


def _align(files: Tokenizers):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, part, row = files.open(), TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            made, size = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                found = opened.groups(text.as_py())
                if found is None:
                    made.append((part + row, doc_id.as_py(), 0, 0, 0, 0, "", b"", b""))
                else:
                    n_a, n_b, sha, linked = found
                    pairs, times = np.unique(linked, return_counts=True)
                    packed = pairs.astype("<i8").tobytes(), times.astype("<i4").tobytes()
                    n = len(linked)
                    made.append((part + row, doc_id.as_py(), n_a, n_b, n, n, sha, *packed))
                    size += len(packed[0])
                row += 1
                if size > 1 << 24:
                    yield _batch(made)
                    made, size = [], 0
            if made:
                yield _batch(made)

    return run


_ALIGNED = pa.schema(
    [(n, pa.int64()) for n in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _ALIGNED)]
    return pa.RecordBatch.from_arrays(columns, schema=_ALIGNED)


def _joined(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of all rows in a row, and how many each row has."""
    cells = [c.as_py() for c in column]
    width = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(cells), kind), np.array([len(c) // width for c in cells])


def _summed(pairs: list[np.ndarray], times: list[np.ndarray]) -> pa.RecordBatch:
    distinct, at = np.unique(np.concatenate(pairs), return_inverse=True)
    n = np.bincount(at, weights=np.concatenate(times)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(n)], ["pair", "n"])


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs, times, size = [], [], 0
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            pairs.append(_joined(part.column(0), "<i8")[0])
            times.append(_joined(part.column(1), "<i4")[0])
            size += len(pairs[-1])
            if size > HELD:
                merged = _summed(pairs, times)
                if merged.num_rows > HELD // 2:
                    yield merged
                    pairs, times, size = [], [], 0
                else:
                    pairs, times = ([np.asarray(merged.column(i))] for i in (0, 1))
                    size = merged.num_rows
    if pairs:
        yield _summed(pairs, times)


def pair_counts(aligned: DataFrame, n_b: int, scratch: Scratch) -> DataFrame:
    """(pair, n, best): links of each id pair, and whether no pair of its B id has more."""
    counted = aligned.select("pairs", "times").mapInArrow(_count_pairs, "pair long, n long")
    counts = scratch.write(counted.groupBy("pair").agg(F.sum("n").alias("n")), "counts")
    b_id = (F.col("pair") % n_b).alias("b_id")
    most = counts.groupBy(b_id).agg(F.max("n").alias("most"))
    # At most one row for each entry of the vocabulary of B.
    marked = counts.withColumn("b_id", b_id).join(F.broadcast(most), "b_id")
    return scratch.write(marked.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "marked")


def _sums(head, rest: bool):
    """Per row the sums over known pairs; or the links of pairs that are not known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = head.value
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                pairs, lengths = _joined(part.column(1), "<i8")
                times = _joined(part.column(2), "<i4")[0]
                rows = np.asarray(part.column(0))
                of = np.repeat(np.arange(len(rows)), lengths)
                at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
                hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
                if rest:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[of[~hit]]), pa.array(pairs[~hit]), pa.array(times[~hit].astype(np.int64))],
                        ["row", "pair", "times"],
                    )
                    continue
                sums = []
                for each in (n, best):
                    total = np.zeros(len(rows), np.int64)
                    np.add.at(total, of[hit], times[hit] * each[at[hit]])
                    sums.append(pa.array(total))
                yield pa.RecordBatch.from_arrays([pa.array(rows), *sums], ["row", "count_sum", "n_best"])

    return run


def align_tokens(docs: DataFrame, files: Tokenizers, head_pairs: int = HEAD) -> DataFrame:
    """One row per document: how the tokens of its text by A and by B lie on each other.

    doc_id, n_a, n_b (tokens), n_groups, n_links, n_best, count_sum, groups_sha256. A reads
    a space and the text, B the text, to which it adds the space itself; strings of special
    tokens are plain text for both. A text that is null or empty, or that one of the two does
    not give back byte by byte, has no tokens: zeros and an empty digest. Two tokens are
    linked where they end together. A pair's count is the number of its links in the whole
    table; ``n_best`` counts links whose pair has the highest count of its B id (ties
    included), ``count_sum`` adds the counts up.

    Very long texts are grouped in blocks of tokens and their digest is built piece by
    piece; besides, a task holds the ids of one text. Repeated rows and ids, null ones too,
    each give a row. Further columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "alignment")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), plain_text().alias("text"))
    layout = f"{DIGEST}, pairs binary, times binary"
    aligned = scratch.write(rows.mapInArrow(_align(files), layout), "aligned")
    counts = pair_counts(aligned, files.open().n_b, scratch)
    head = counts.orderBy(F.desc("n"), "pair").limit(head_pairs).toArrow().sort_by("pair")
    arrays = [np.asarray(head.column(c).combine_chunks().cast(pa.int64())) for c in ("pair", "n", "best")]
    sent = spark.sparkContext.broadcast(tuple(arrays))
    links = aligned.select("row", "pairs", "times")
    sums = "row long, count_sum long, n_best long"
    known = scratch.write(links.mapInArrow(_sums(sent, False), sums), "known")
    rarer = links.mapInArrow(_sums(sent, True), "row long, pair long, times long").join(counts, "pair")
    added = scratch.write(
        rarer.groupBy("row").agg(
            F.sum(F.col("times") * F.col("n")).alias("more"),
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        ),
        "added",
    )
    sent.destroy()
    none = F.lit(0).cast("long")
    return (
        aligned.drop("pairs", "times").join(known, "row").join(added, "row", "left")
        .select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links",
            (F.col("n_best") + F.coalesce("more_best", none)).alias("n_best"),
            (F.col("count_sum") + F.coalesce("more", none)).alias("count_sum"),
            "groups_sha256",
        )
    )
