"""Exact duplicates by an exchange of Golomb-coded fingerprints (operator 6).

1. Each task cuts its documents into chunks and sends every owner (a range of fingerprint
   values) one message: the chunk's distinct fingerprints in that range, sorted, as
   Golomb-coded gaps. Copies inside a chunk are merged before anything is sent, so the
   most frequent text costs an owner one fingerprint per chunk.
2. Owners answer each message with a bitmap: which of its fingerprints came from elsewhere
   as well.
3. Only documents whose bit is set are suspects. Their texts are shuffled and compared byte
   by byte; short fingerprints may raise a false suspicion, never a false duplicate.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.shared import Scratch, plain_text, shuffle_width

FINGERPRINT_BITS = 48
CHUNK_DOCUMENTS = 200_000
OWNER_PRINTS = 500_000  # about as many fingerprints as an owner gets

MESSAGES = (
    "chunk string, owner int, count int, bits int, gaps binary, low binary, "
    "repeated binary, places array<int>, doc_ids array<long>, hashes array<binary>"
)


def golomb(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Rice code of sorted distinct values: parameter, unary quotients, binary remainders.

    Quotients and remainders stand in a stream each, so that both sides work on arrays.
    """
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    bits = int(np.log2(max(1.0, float(values[-1]) / len(values) * 0.69)))
    quotients = (gaps >> np.uint64(bits)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, np.uint8)
    unary[ends] = 1
    places = np.arange(bits, dtype=np.uint64)
    low = ((gaps[:, None] >> places) & np.uint64(1)).astype(np.uint8)
    return bits, np.packbits(unary).tobytes(), np.packbits(low.reshape(-1)).tobytes()


def from_golomb(count: int, bits: int, unary: bytes, low: bytes) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:count]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(bits)
    if bits:
        table = np.unpackbits(np.frombuffer(low, np.uint8), count=count * bits)
        places = np.uint64(1) << np.arange(bits, dtype=np.uint64)
        gaps += table.reshape(count, bits).astype(np.uint64) @ places
    return np.cumsum(gaps, dtype=np.uint64)


def _bitmap(flags: np.ndarray) -> bytes:
    return np.packbits(flags.astype(np.uint8)).tobytes()


def _flags(bitmap: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bitmap, np.uint8), count=count).astype(bool)


def _messages(owners: int, bits: int, chunk_documents: int):
    """A function from rows (doc_id, sha) to the messages of their chunks."""

    def send(pieces: list[pd.DataFrame], chunk: str) -> Iterator[pd.DataFrame]:
        rows = pd.concat(pieces)
        hashes = rows["sha"].to_numpy()
        head = np.frombuffer(b"".join(hashes), ">u8").reshape(-1, 4)[:, 0].astype(np.uint64)
        prints = head >> np.uint64(64 - bits)
        distinct, places, counts = np.unique(prints, return_inverse=True, return_counts=True)
        order = np.argsort(places, kind="stable")
        doc_ids = rows["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None)[order]
        hashes, places = hashes[order], places[order]
        # Owners share the range of values evenly; sorted values stand owner by owner.
        owner_of = ((distinct >> np.uint64(bits - 32)) * np.uint64(owners)) >> np.uint64(32)
        for owner in np.unique(owner_of):
            first, last = np.searchsorted(owner_of, [owner, owner + np.uint64(1)])
            begin, end = np.searchsorted(places, [first, last])
            least = np.uint64(-(-(int(owner) << 32) // owners) << (bits - 32))
            k, unary, low = golomb(distinct[first:last] - least)
            yield pd.DataFrame({
                "chunk": [chunk], "owner": [int(owner)], "count": [int(last - first)], "bits": [k],
                "gaps": [unary], "low": [low], "repeated": [_bitmap(counts[first:last] > 1)],
                "places": [(places[begin:end] - first).astype(np.int32)],
                "doc_ids": [list(doc_ids[begin:end])], "hashes": [list(hashes[begin:end])],
            })

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        context = TaskContext.get()
        held, size, number = [], 0, 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= chunk_documents:
                yield from send(held, f"{context.taskAttemptId()}-{number}")
                held, size, number = [], 0, number + 1
        if size:
            yield from send(held, f"{context.taskAttemptId()}-{number}")

    return run


def _answers(messages: pd.DataFrame) -> pd.DataFrame:
    """For each message of one owner, which fingerprints another message has too."""
    columns = (messages[c] for c in ("count", "bits", "gaps", "low"))
    prints = [from_golomb(*m) for m in zip(*columns)]
    distinct, places, counts = np.unique(
        np.concatenate(prints), return_inverse=True, return_counts=True
    )
    shared, at, maps = counts[places] > 1, 0, []
    for values in prints:
        maps.append(_bitmap(shared[at : at + len(values)]))
        at += len(values)
    return pd.DataFrame({"chunk": messages["chunk"], "owner": messages["owner"], "shared": maps})


def _suspicions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for m in batch.itertuples(index=False):
            flags = _flags(m.repeated, m.count) | _flags(m.shared, m.count)
            yield pd.DataFrame({
                "doc_id": pd.array(m.doc_ids, dtype="Int64"), "sha": list(m.hashes),
                "suspect": flags[np.asarray(m.places, np.int64)],
            })


def exact_duplicates(
    docs: DataFrame,
    fingerprint_bits: int = FINGERPRINT_BITS,
    chunk_documents: int = CHUNK_DOCUMENTS,
    owner_prints: int = OWNER_PRINTS,
) -> DataFrame:
    """One row per document: which row of its group of equal texts stays.

    doc_id, keep_id (largest doc_id of the group), group_size, kept, text_sha256. Null and
    empty texts are equal. A null doc_id counts as the smallest and makes keep_id null only
    in a group of such rows. Of rows that repeat a doc_id in a group, one is kept. Further
    columns are ignored; an empty table gives an empty result. If two different texts had
    one SHA-256 value, the run would fail, not merge them.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(plain_text(), 256)).alias("sha"),
        plain_text().alias("text"),
    )
    prints = rows.select("doc_id", "sha")
    owners = max(shuffle_width(docs.sparkSession), prints.count() // owner_prints + 1)
    send = _messages(owners, fingerprint_bits, chunk_documents)
    messages = scratch.write(prints.mapInPandas(send, MESSAGES), "messages")
    answers = (
        messages.select("chunk", "owner", "count", "bits", "gaps", "low")
        .groupBy("owner")
        .applyInPandas(_answers, "chunk string, owner int, shared binary")
    )
    told = scratch.write(
        messages.join(answers, ["chunk", "owner"])
        .select("count", "repeated", "shared", "places", "doc_ids", "hashes")
        .mapInPandas(_suspicions, "doc_id long, sha binary, suspect boolean"),
        "told",
    )
    alone = told.where("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha",
    )
    # Rows of one id and one text are one entry with a count.
    members = (
        told.where("suspect").groupBy("sha", "doc_id").agg(F.count("*").alias("times"))
    )
    suspected = members.select("sha").distinct()
    verified = (
        rows.join(suspected, "sha", "left_semi")
        .groupBy("sha", "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    groups = verified.groupBy("sha").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"),
        F.count("*").alias("texts"),
    )
    same = F.col("texts") == 1
    found = members.join(groups, "sha").where(
        same | F.raise_error(F.lit("two texts with one SHA-256 value")).cast("boolean")
    )
    copies = found.select(
        "doc_id", "keep_id", "group_size", "sha",
        F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy"),
    ).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "sha",
    )
    return alone.unionByName(copies).select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
