"""Aligned tokens against the two libraries and plain Python."""

import hashlib
import random
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cases import documents, empty, frame
from salesmart.llm import alignment
from salesmart.llm.tokens import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FILES = alignment.Tokenizers(A, B)
PARTS = [
    "a", "the", "é", " ", "  ", "\n", "\n\n", "\t", "\r\n", "'s", "12", "!!", "<|endoftext|>", "<s>",
    "▁", "\xa0", "日本", "👍🏽", "ﬁ", "\x00", "Word", " word.", "<0x41>", " ", "\x1c",
]


def test_ids_equal_the_library():
    """Merging by ranks gives the ids of the file, special tokens taken as plain text."""
    ours, rng = FILES.open(), random.Random(5)
    whole = Tokenizer.from_file(A)
    whole.encode_special_tokens = True
    for _ in range(3000):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 9)))
        assert ours.ids(text)[0].tolist() == whole.encode(" " + text, add_special_tokens=False).ids, text


def brute_force(rows):
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    byte = {letter: b for b, letter in enumerate(byte_letters())}
    told, links = [], []
    for doc_id, text, *_ in rows:
        spelled = b" " + (text or "").encode()
        a = first.encode(spelled.decode(), add_special_tokens=False).ids
        of_a = [bytes(byte[c] for c in first.id_to_token(i)) for i in a]
        b = second.encode(text or "")
        of_b = []
        for i in b:
            piece = second.id_to_piece(i)
            of_b.append(bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode())
        if not text or b"".join(of_a) != spelled or b"".join(of_b) != spelled:
            told.append((doc_id, 0, 0, 0, ""))
            links.append([])
            continue
        ends_a, ends_b = (list(accumulate(map(len, x))) for x in (of_a, of_b))
        mine, where = [], {e: i for i, e in enumerate(ends_a)}
        parts, i, k = [], 0, 0
        for at, end in enumerate(ends_b):
            if end in where:
                parts.append(f"{','.join(map(str, a[i : where[end] + 1]))}|{','.join(map(str, b[k : at + 1]))}")
                mine.append((a[where[end]], b[at]))
                i, k = where[end] + 1, at + 1
        told.append((doc_id, len(a), len(b), len(parts), hashlib.sha256(";".join(parts).encode()).hexdigest()))
        links.append(mine)
    counts = Counter(p for each in links for p in each)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return Counter(
        (d, n_a, n_b, groups, len(mine), sum(counts[p] == best[p[1]] for p in mine), sum(counts[p] for p in mine), sha)
        for (d, n_a, n_b, groups, sha), mine in zip(told, links)
    )


@pytest.mark.parametrize("head, block", [(0, 7), (40, 1 << 16), (1 << 19, 1 << 16)])
def test_alignment_equals_brute_force(spark, monkeypatch, head, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    rng = random.Random(7)
    odd = [(200 + i, "".join(rng.choices(PARTS, k=12)), None, None, 0) for i in range(60)]
    rows = documents() + odd
    made = alignment.align_tokens(frame(spark, rows, clashes=True), FILES, head)
    expected = brute_force(rows)
    assert Counter(tuple(r) for r in made.collect()) == expected
    assert sum(1 for r in expected if r[1] == 0) > 3


def test_no_documents(spark):
    assert alignment.align_tokens(empty(spark), FILES).count() == 0
