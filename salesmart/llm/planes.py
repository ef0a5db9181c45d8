"""Token ids in files of compressed bit or byte planes (operator 10).

A file holds a run of documents: blocks of ids, each block transposed into planes (all the
lowest bytes, then all the next, or bit by bit), each plane compressed by itself, and an
index at the end. High planes of small ids are nearly constant and compress to almost
nothing; a reader can fetch one block without the others.

    b"PLN1" | planes ... | index (zstandard, JSON head, arrays) | index length (8) | b"PLN1"
"""

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.llm import tokens
from salesmart.llm.shared import Scratch, plain_text, shuffle_width

MAGIC = b"PLN1"
BLOCK_IDS = 1 << 18
FILES_SCHEMA = "file long, path string, documents long, ids long, bytes long"
READ_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, lowest first."""
    table = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [np.ascontiguousarray(table[:, i]).tobytes() for i in range(4)]
    bits = np.unpackbits(table, axis=1, bitorder="little")
    return [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(32)]


def from_planes(planes: list[bytes], count: int) -> np.ndarray:
    if len(planes) == 4:
        table = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        columns = [
            np.unpackbits(np.frombuffer(p, np.uint8), count=count, bitorder="little")
            for p in planes
        ]
        table = np.packbits(np.stack(columns, axis=1), axis=1, bitorder="little")
    return np.ascontiguousarray(table).view("<u4").reshape(-1)


class Writer:
    """Writes one file; ``add`` takes documents in order."""

    def __init__(self, sink, kind: str = "byte", block_ids: int = BLOCK_IDS):
        self._sink, self._kind, self._block_ids = sink, kind, block_ids
        self._codec = zstandard.ZstdCompressor(level=3)
        self._waiting, self._waiting_ids = [], 0
        self.blocks: list[dict] = []
        self.keys: list[int | None] = []
        self.lengths: list[int] = []
        sink.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, key: int | None, ids: bytes) -> None:
        self.keys.append(key)
        self.lengths.append(len(ids) // 4)
        self._waiting.append(ids)
        self._waiting_ids += len(ids) // 4
        if self._waiting_ids >= self._block_ids:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self._waiting), "<u4")
        step = self._block_ids
        whole = len(ids) if last else len(ids) - len(ids) % step
        for first in range(0, whole, step):
            block = ids[first : min(first + step, whole)]
            packed = [self._codec.compress(p) for p in to_planes(block, self._kind)]
            self.blocks.append({
                "at": self.at, "ids": len(block), "sizes": [len(p) for p in packed],
                "crc32": zlib.crc32(block.tobytes()),
            })
            for plane in packed:
                self._sink.write(plane)
                self.at += len(plane)
        self._waiting, self._waiting_ids = [ids[whole:].tobytes()], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        nulls = np.array([k is None for k in self.keys], np.uint8)
        keys = np.array([k or 0 for k in self.keys], "<i8")
        head = json.dumps({"blocks": self.blocks, "documents": len(keys)}).encode()
        index = self._codec.compress(b"".join([
            len(head).to_bytes(8, "little"), head, nulls.tobytes(), keys.tobytes(),
            np.array(self.lengths, "<i8").tobytes(),
        ]))
        self._sink.write(index + len(index).to_bytes(8, "little") + MAGIC)
        self.at += len(index) + 12


class Reader:
    """Reads one file block by block, using its index."""

    def __init__(self, source):
        size = source.size()
        source.seek(size - 12)
        tail = source.read(12)
        if tail[8:] != MAGIC:
            raise ValueError("not a file of planes, or cut short")
        length = int.from_bytes(tail[:8], "little")
        source.seek(size - 12 - length)
        self._codec, self._source = zstandard.ZstdDecompressor(), source
        index = self._codec.decompress(source.read(length))
        n = int.from_bytes(index[:8], "little")
        head = json.loads(index[8 : 8 + n])
        self.blocks, count, at = head["blocks"], head["documents"], 8 + n
        nulls = np.frombuffer(index, np.uint8, count, at)
        keys = np.frombuffer(index, "<i8", count, at + count)
        self.lengths = np.frombuffer(index, "<i8", count, at + 9 * count)
        self.keys = [None if null else int(k) for k, null in zip(keys, nulls)]

    def block(self, number: int) -> bytes:
        entry = self.blocks[number]
        self._source.seek(entry["at"])
        planes = [self._codec.decompress(self._source.read(s)) for s in entry["sizes"]]
        ids = from_planes(planes, entry["ids"]).tobytes()
        if zlib.crc32(ids) != entry["crc32"]:
            raise ValueError(f"block {number} is damaged")
        return ids

    def documents(self) -> Iterator[tuple[int | None, Iterator[bytes]]]:
        """Each document's key and its ids in pieces."""
        held, number = b"", 0

        def pieces(want: int) -> Iterator[bytes]:
            nonlocal held, number
            while want:
                if not held:
                    held, number = self.block(number), number + 1
                piece, held = held[:want], held[want:]
                want -= len(piece)
                yield piece

        for key, length in zip(self.keys, self.lengths):
            yield key, pieces(int(length) * 4)


def filesystem(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a folder named by URI (file, hdfs, s3, gs), and its path there."""
    return pyarrow.fs.FileSystem.from_uri(folder)


@dataclass(frozen=True)
class Coding:
    """Tokenizer file, end id, kind of planes, ids in a block."""

    tokenizer: str
    end_id: int = 2
    kind: str = "byte"
    block_ids: int = BLOCK_IDS


def write_ids(docs: DataFrame, folder: str, coding: Coding, files: int | None = None) -> DataFrame:
    """Encode texts and write them in ascending doc_id order; one row per file written.

    Null texts count as empty, null ids come first, rows with one id are ordered by their
    text, and further columns are ignored. An empty table writes no file. Tasks write a
    file under a name of their own and rename it when it is whole, so that a repeated
    task replaces it by the same bytes.
    """
    spark = docs.sparkSession
    files = files or shuffle_width(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), plain_text().alias("text"))
    ordered = rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")

    def write(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = filesystem(folder)
        encode = tokens.encoder(coding.tokenizer).encode
        context, end = TaskContext.get(), coding.end_id.to_bytes(4, "little")
        name = f"{base}/part-{context.partitionId():06d}.pln"
        own, writer, sink = f"{name}.{context.taskAttemptId()}", None, None
        for chunk in chunks:
            for key, text in zip(chunk["doc_id"], chunk["text"]):
                if writer is None:
                    store.create_dir(base, recursive=True)
                    sink = store.open_output_stream(own)
                    writer = Writer(sink, coding.kind, coding.block_ids)
                writer.add(None if pd.isna(key) else int(key), encode(text) + end)
        if writer is not None:
            writer.close()
            sink.close()
            store.move(own, name)
            yield pd.DataFrame({
                "file": [context.partitionId()], "path": [name],
                "documents": [len(writer.keys)], "ids": [sum(writer.lengths)],
                "bytes": [writer.at],
            })

    return ordered.mapInPandas(write, FILES_SCHEMA)


def read_ids(files: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """Documents of written files: place, length, checksum and, if wanted, the ids.

    ``start`` counts the ids of all documents before; the running sum it needs is over one
    row per file. Files are read by as many tasks as there are shuffle partitions, a block
    at a time.
    """
    before = F.coalesce(
        F.sum("ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    spread = files.withColumn("before", before).repartition(
        shuffle_width(files.sparkSession), "file"
    )

    def read(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = filesystem(folder)
        for chunk in chunks:
            for path, start in zip(chunk["path"], chunk["before"]):
                with store.open_input_file(path) as source:
                    rows, held = [], 0
                    for key, pieces in Reader(source).documents():
                        crc, count, parts = 0, 0, []
                        for piece in pieces:
                            crc, count = zlib.crc32(piece, crc), count + len(piece) // 4
                            if with_ids:
                                parts.append(piece)
                        rows.append((key, start, count, crc, b"".join(parts) if with_ids else None))
                        start, held = start + count, held + (count if with_ids else 16)
                        if held > 1 << 20:
                            yield _frame(rows)
                            rows, held = [], 0
                    if rows:
                        yield _frame(rows)

    return spread.mapInPandas(read, READ_SCHEMA)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
    return frame.astype({"doc_id": "Int64"})


def round_trip(docs: DataFrame, coding: Coding) -> DataFrame:
    """Write the documents' ids into files of a scratch folder and read them back."""
    scratch = Scratch(docs.sparkSession, "planes")
    folder = scratch.path("files")
    files = scratch.write(write_ids(docs, folder, coding), "list")
    return read_ids(files, folder, with_ids=False).drop("ids")
