"""Spelling variants against all pairs of words in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from cases import documents, empty, frame
from salesmart.llm import variants


def brute_force(rows, rules):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= rules.least_count and len(w) >= rules.least_length}
    near = {w: set() for w in words}
    cut = {}  # a word without its letter i: words that differ there share it
    for w in words:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
            others = cut.setdefault((i, shorter), set())
            for other in others:
                near[w].add(other)
                near[other].add(w)
            others.add(w)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            if words[best] >= 10 * words[w]:
                form[w] = best
    found = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        found.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return found


def rows():
    """Families of words a letter apart, in very different numbers, beside the odd table."""
    rng = random.Random(11)
    letters = "abcdeéÿz"
    roots = ["".join(rng.choices(letters, k=rng.randint(6, 9))) for _ in range(12)]
    texts = []
    for root in roots:
        for times in (400, 30, 2, 2, 3):
            at, kind = rng.randrange(len(root)), rng.randrange(3)
            letter = rng.choice(letters)
            word = root[:at] + ("", letter, letter + root[at])[kind] + root[at + 1 :]
            texts.append(" ".join([word.title() if times == 3 else word] * times))
    texts += ["z" * 5000 + " " + "z" * 5001, "z" * 5000 + " " + "z" * 5001, "naïveté÷×test " * 3]
    # Anagrams: many words of one path.
    texts += [" ".join("".join(rng.sample("abcdefg", 7)) for _ in range(60)) for _ in range(6)]
    return documents() + [(100 + i, t, None, None, 0) for i, t in enumerate(texts)]


@pytest.mark.parametrize("node_words", [40, 20_000])
def test_variants_equal_brute_force(spark, node_words):
    rules = variants.Spelling(node_words=node_words)
    made = variants.spelling_variants(frame(spark, rows(), clashes=True), rules)
    assert made.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = [tuple(r) for r in made.collect()]
    expected = brute_force(rows(), rules)
    assert len(found) == len(set(found)) and set(found) == expected
    assert any(r[1] for r in expected) and any(r[1] not in (None, r[2]) for r in expected)


def test_no_words(spark):
    assert variants.spelling_variants(empty(spark)).count() == 0
    short = frame(spark, [(1, "one two", None, None, 0), (2, None, None, None, 0)])
    assert variants.spelling_variants(short).count() == 0
