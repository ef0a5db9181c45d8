"""The encoder against the library, packing and files of planes against plain Python."""

import collections
import io
import random
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cases import documents, empty, frame
from salesmart.llm import packing, planes
from salesmart.llm.shared import Scratch
from salesmart.llm.tokens import Encoder

BYTE, WORD = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_the_library(path, monkeypatch):
    monkeypatch.setattr("salesmart.llm.tokens.MOST_WORDS", 50)  # forget often
    encoder, rng = Encoder(path), random.Random(5)
    fresh = Tokenizer.from_file(path)
    parts = [
        "a", "B", "é", "é", " ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", "'s", "'", "1", "23",
        "!!", ".", ",", "<|endoftext|>", "<|StartOfText|>", "\x1c", "\xa0", "　", "Σ", "ΑΣ", "İ", "ß", "日本", "​",
        "👍🏽", "x'll", "ﬁ", "\x00", "\x85", " word", " Word.",
    ]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 9)))
        assert encoder.encode(text) == encoder.library(text), text
        # The library as it is opened by itself.
        assert encoder.encode(text) == array("I", fresh.encode(text, add_special_tokens=False).ids).tobytes()
    for _, text, *_ in documents():
        assert encoder.encode(text or "") == encoder.library(text or "")


def encoded(path, end):
    encoder = Encoder(path)
    return [(r[0], encoder.library(r[1] or "") + end.to_bytes(4, "little")) for r in documents()]


def test_packing(spark):
    windows = packing.Windows(WORD, size=256)
    packed = packing.pack(frame(spark, clashes=True), windows)
    rows = packed.collect()
    by_document = collections.defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_document[r.doc_id, r.doc_tokens].append(r)
    pieces = collections.Counter()
    for key, ids in encoded(WORD, 1):
        for at in range(0, len(ids), 1024):
            pieces[key, at // 4, ids[at : at + 1024]] += 1
    assert collections.Counter((r.doc_id, r.start, bytes(r.ids)) for r in rows) == pieces
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_sequence) == set(range(len(by_sequence)))
    for places in by_sequence.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 256
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert sum(len(v) for v in whole.values()) == sum(4 * r.length for r in rows)
    for r in rows:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert packing.pack(empty(spark), windows).count() == 0


def plain_best_fit(lengths, size):
    """Number of windows by best-fit decreasing, one piece at a time."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= n]
        if fits:
            best = min(fits, key=lambda i: room[i])
            room[best] -= n
        else:
            room.append(size - n)
    return sorted(room)


@pytest.mark.parametrize("seed", range(12))
def test_best_fit_in_bulk_is_best_fit(seed):
    rng = random.Random(seed)
    size = rng.choice([16, 64, 100])
    few = [rng.randint(1, size) for _ in range(4)]
    lengths = [rng.choice(few) if seed % 2 else rng.randint(1, size) for _ in range(300)]
    steps = packing.best_fit(collections.Counter(lengths), size)
    used, ordered = collections.defaultdict(list), sorted(lengths, reverse=True)
    starts = list(steps[:, 0]) + [len(lengths)]
    for (first, length, window, each, offset), last in zip(steps.tolist(), starts[1:]):
        for place in range(first, last):
            nth = place - first
            assert ordered[place] == length
            used[window + nth // each].append((offset + nth % each * length, length))
    for places in used.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= size
    assert sorted(size - sum(n for _, n in p) for p in used.values()) == plain_best_fit(lengths, size)


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(2)
    for n in (0, 1, 7, 1000):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        assert (planes.from_planes(planes.to_planes(ids, kind), n) == ids).all()
    sink = io.BytesIO()
    writer = planes.Writer(sink, kind, block_ids=10)
    docs = [(i if i != 3 else None, rng.integers(0, 50_000, i * 7).astype("<u4").tobytes()) for i in range(6)]
    for key, ids in docs:
        writer.add(key, ids)
    writer.close()
    assert writer.at == len(sink.getvalue())
    source = io.BytesIO(sink.getvalue())
    source.size = lambda: len(sink.getvalue())
    reader = planes.Reader(source)
    assert [(k, b"".join(p)) for k, p in reader.documents()] == docs
    assert reader.block(2) == b"".join(ids for _, ids in docs)[80:120]
    broken = io.BytesIO(sink.getvalue()[:-5])
    broken.size = lambda: len(broken.getvalue())
    with pytest.raises(ValueError):
        planes.Reader(broken)


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_files_of_ids(spark, kind):
    coding = planes.Coding(BYTE, 2, kind, block_ids=500)
    scratch = Scratch(spark, "test")
    folder = scratch.path("files")
    files = scratch.write(planes.write_ids(frame(spark, clashes=True), folder, coding, 3), "list")
    got = sorted(planes.read_ids(files, folder).collect(), key=lambda r: r.start)
    expected = sorted(
        zip(encoded(BYTE, 2), documents()), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1][1] or "")
    )
    at = 0
    for row, ((key, ids), _) in zip(got, expected, strict=True):
        assert (row.doc_id, row.start, row.n_tokens) == (key, at, len(ids) // 4)
        assert bytes(row.ids) == ids and row.ids_crc32 == zlib.crc32(ids)
        at += row.n_tokens
    assert planes.round_trip(empty(spark), coding).count() == 0
