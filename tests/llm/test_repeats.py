"""Deleted repeats against every window of every text in plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cases import documents, empty, frame
from salesmart.llm import repeats


def brute_force(rows, window):
    """Rows of one doc_id are one document; rows alike in id and text are one row."""
    texts = {(-1 if d is None else d, (t or "")) for d, t, *_ in rows}
    seen = {}
    for doc_id, text in texts:
        data = text.encode()
        for at in range(len(data) - window + 1):
            key, place = data[at : at + window], (doc_id, at)
            seen[key] = min(seen.get(key, place), place)
    results = Counter()
    for d, t, *_ in rows:
        doc_id, data = -1 if d is None else d, (t or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for at in range(len(data) - window + 1):
            if seen[data[at : at + window]] < (doc_id, at):
                gone[at : at + window] = True
        runs = int((np.diff(gone[:-1].astype(int), prepend=0) == 1).sum()) if len(data) else 0
        kept = bytes(np.frombuffer(data, np.uint8)[~gone[:-1]])
        results[d, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
    return results


def rows():
    """Passages in changing surroundings, shifted and cut, beside the odd table."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(60) for _ in range(4)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 4)):
            text = rng.choice(shared)
            parts += [prose(rng.randint(0, 12)), text[rng.randint(0, 150) : rng.randint(150, len(text))]]
        texts.append(" ".join(parts))
    texts += ["y" * 99, "y" * 100, "y" * 400, "ab" * 200, shared[0][:100], shared[0][1:101], shared[0] * 3]
    # Another text under a number that is taken would leave open which of two is earlier.
    odd = [r for r in documents() if r[1] != "another text under a number that is taken already"]
    return odd + [(100 + i, t, None, None, 0) for i, t in enumerate(texts)]


@pytest.mark.parametrize("rules", [
    repeats.Repeats(), repeats.Repeats(bucket_anchors=4), repeats.Repeats(window=50, gram=17),
])
def test_repeats_equal_brute_force(spark, rules, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE_BYTES", 1000)
    made = repeats.digest(repeats.delete_repeats(frame(spark, rows(), clashes=True), rules))
    assert made.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    expected = brute_force(rows(), rules.window)
    found = Counter(tuple(r) for r in made.collect())
    assert found == expected
    assert sum(1 for r in expected if 0 < r[2] < r[1]) > 20


def test_kept_bytes_and_spans(spark):
    text = "".join(random.Random(1).choices("abcdefgh", k=300))
    docs = frame(spark, [(1, text, None, None, 0), (2, "é" + text[50:250] + "é", None, None, 0)])
    first, second = repeats.delete_repeats(docs).orderBy("doc_id").collect()
    assert bytes(first.kept).decode() == text and first.spans == []
    assert bytes(second.kept).decode() == "éé" and [tuple(s) for s in second.spans] == [(2, 202)]


def test_no_documents(spark):
    assert repeats.delete_repeats(empty(spark)).count() == 0


def test_grams_of_a_piece_are_hashed_at_once():
    data = np.frombuffer(random.Random(4).randbytes(5000), np.uint8)
    rolling, at = repeats.Rolling(data), np.arange(5000 - 32 + 1)
    assert np.array_equal(rolling.grams(32), rolling.hashes(at, at + 32))
    assert len(repeats.Rolling(data[:32]).grams(32)) == 1
