"""Exact duplicates, repeated lines and the Jaccard join, against plain Python."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from cases import documents, empty, frame, words
from salesmart.llm import exact, jaccard, lines
from salesmart.llm.shared import Scratch, components


def counted(rows):
    return collections.Counter(tuple(r) for r in rows)


def expected_exact(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = collections.Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            kept = i == keep and left == 1
            left -= kept
            out[(i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("bits,chunk", [(48, 200_000), (34, 4)])
def test_exact_duplicates(spark, bits, chunk):
    """Short fingerprints raise false suspicions, small chunks copies in many messages."""
    found = exact.exact_duplicates(frame(spark, clashes=True), bits, chunk, owner_prints=5)
    assert counted(found.collect()) == expected_exact(documents())


def test_exact_duplicates_of_nothing(spark):
    assert exact.exact_duplicates(empty(spark)).count() == 0


def test_golomb_round_trip():
    rng = np.random.default_rng(1)
    for size, top in ((1, 1), (5, 9), (1000, 1 << 20), (3000, 1 << 44)):
        values = np.unique(rng.integers(0, top, size).astype(np.uint64))
        code = exact.golomb(values)
        assert (exact.from_golomb(len(values), *code) == values).all()
        if top == 1 << 44:
            assert len(code[1]) + len(code[2]) < 8 * len(values) * 0.7


def expected_lines(rows, min_chars=20, most_lines=25):
    """Texts after deleting every run of enough characters that stands earlier."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    runs, split = collections.defaultdict(list), [(r[1] or "").split("\n") for r in rows]
    for place, i in enumerate(order):
        for s in range(len(split[i])):
            for e in range(s + 1, min(len(split[i]), s + most_lines) + 1):
                if sum(len(x) + 1 for x in split[i][s:e]) >= min_chars:
                    runs[tuple(split[i][s:e])].append((place, s))
    gone = collections.defaultdict(set)
    for run, places in runs.items():
        for place, s in sorted(places)[1:]:
            gone[order[place]].update(range(s, s + len(run)))
    return [
        None if r[1] is None else "\n".join(x for k, x in enumerate(split[i]) if k not in gone[i])
        for i, r in enumerate(rows)
    ]


def test_repeated_lines(spark):
    rows = [r for r in documents() if r[0] not in (5, None)]  # order within a number: see below
    rows = [r for r in rows if len(r[1] or "") < 20_000] + [
        (50, "\n".join(["x", "", "y", "", "z"] * 3 + ["a line of some length"]), None, None, 0),
        (51, "\n".join(["y", "", "z", "", "x", "a line of some length", "tail"]), None, None, 0),
        (52, "\n".join(str(i % 7) for i in range(60)), None, None, 0),
        (53, "\n".join(str(i % 7) for i in range(30)), None, None, 0),
    ]
    found = lines.delete_repeated_runs(frame(spark, rows, clashes=True), 20)
    assert counted(found.select("doc_id", "text").collect()) == counted(
        zip([r[0] for r in rows], expected_lines(rows))
    )
    assert set(frame(spark, clashes=True).columns) < set(found.columns)


def test_repeated_passages(spark):
    """Runs from 200 characters: passages of several lines go, repeats of short ones stay."""
    rng = random.Random(21)
    line = lambda n: " ".join(words(rng, n))
    common = [line(4) for _ in range(5)]
    passage, one = [line(9) for _ in range(8)], line(90)
    rows = []
    for i in range(40):
        own = [line(rng.randint(1, 30)) for _ in range(rng.randint(2, 9))]
        own.insert(rng.randint(0, len(own)), rng.choice(common))
        if i % 4 == 0:
            at = rng.randint(0, len(own))
            own[at:at] = passage if i % 8 == 0 else [one]
        rows.append((i, "\n".join(own), "en", "s", 0))
    rows += [(50, "\n" * 300 + "tail", None, None, 0), (51, "x\n" + "\n" * 250, None, None, 0)]
    rows += [(52, "\n".join(passage[:3]), None, None, 0), (53, "\n".join(common), None, None, 0)]
    rows += [(54, None, None, None, 0), (None, "\n".join(passage), None, None, 0), (55, "", None, None, 0)]
    found = lines.delete_repeated_runs(frame(spark, rows, clashes=True), 200).collect()
    plain = expected_lines(rows, 200, 400)
    assert counted((r.doc_id, r.text) for r in found) == counted(zip([r[0] for r in rows], plain))
    changed = {r[0] for r, text in zip(rows, plain) if text != r[1]}
    assert changed == {*range(8, 40, 4), 50, 51, None}
    assert not any(passage[3] in (r.text or "") for r in found if r.doc_id != 0)


def test_short_repeated_runs_go(spark):
    """Production parameter: a run of 20 characters counts, of one line or of several."""
    rows = [
        (1, "own first line\na line that stands twice\nab\ncd ef\ngh ij kl mn op\nend", None, None, 0),
        (2, "another line\na line that stands twice\ntail", None, None, 0),
        (3, "ab\ncd ef\ngh ij kl mn op\nlast", None, None, 0),
        (4, "ab\ncd ef\nless than twenty", None, None, 0),
    ]
    found = lines.delete_repeated_runs(frame(spark, rows, clashes=True)).collect()
    left = {r.doc_id: r.text for r in found}
    assert left == {1: rows[0][1], 2: "another line\ntail", 3: "last", 4: rows[3][1]}
    assert counted((r.doc_id, r.text) for r in found) == counted(
        zip([r[0] for r in rows], expected_lines(rows))
    )


def test_repeated_lines_of_a_repeated_number(spark):
    rows = [(5, "some line that is long enough " * 8, None, None, 0)] * 2
    found = lines.delete_repeated_runs(frame(spark, rows)).select("text").collect()
    assert sorted(r[0] for r in found) == ["", rows[0][1]]
    assert lines.delete_repeated_runs(empty(spark)).count() == 0


def test_line_dedup_is_native(spark):
    """No Python in any plan, and no window over all rows."""
    run = lines.LineDedup(frame(spark))
    for df in (run.blocks(), run.runs(), run.texts()):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "InPandas" not in plan and "Arrow" not in plan
        assert "SinglePartition" not in plan


def shingle_set(text, k):
    table = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(table))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def expected_components(rows, k, percent):
    sets = [shingle_set(r[1], k) for r in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = collections.Counter()
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out[(r[0], len(sets[i]), min(ids, default=None) if sets[i] else r[0])] += 1
    return out


@pytest.mark.parametrize("k,percent", [(4, 85), (1, 50)])
def test_jaccard_join(spark, k, percent):
    found = jaccard.jaccard_components(frame(spark, clashes=True), jaccard.Similarity(k, percent))
    rows = found.select("doc_id", "n_shingles", "component_id").collect()
    assert counted(rows) == expected_components(documents(), k, percent)


def families(count):
    """A family of drifting near copies, many documents with one passage, short mixtures."""
    rng = random.Random(8)
    base, passage, rows = words(rng, 120), words(rng, 40), []
    for i in range(count):
        w = list(base)
        for _ in range(i // 4):
            w[rng.randrange(len(w))] = f"edit{rng.random()}"
        rows.append(w)
        rows.append(words(rng, 15) + passage + [f"own{i}x{j}" for j in range(25)])
        rows.append([f"w{rng.randrange(4)}" for _ in range(rng.randint(3, 7))])
    return [(i, " ".join(w), None, None, 0) for i, w in enumerate(rows)]


def test_jaccard_join_of_crowded_regions(spark, monkeypatch):
    """Crowded pivots move to the end of the order, and nothing is lost."""
    monkeypatch.setattr(jaccard, "MOST_STRAYS", 3)
    monkeypatch.setattr(jaccard, "SPARE", 0)
    rows = families(40)
    found = jaccard.jaccard_components(frame(spark, rows), jaccard.Similarity(4, 85))
    assert counted(found.select("doc_id", "n_shingles", "component_id").collect()) == (
        expected_components(rows, 4, 85)
    )


def test_jaccard_join_makes_few_pairs_of_a_family(spark, monkeypatch):
    """Copies too far from each other for a link do not meet, however many they are."""
    rng, made = random.Random(13), []
    base = [f"b{i}" for i in range(150)]
    rows = [(0, " ".join(base), None, None, 0)]
    for i in range(1, 200):
        w = list(base)
        for at in rng.sample(range(4, 146), 5 if i % 4 else 1):
            w[at] = f"own{i}x{at}"
        rows.append((i, " ".join(w), None, None, 0))
    measure = jaccard.JaccardJoin._measure

    def counting(self, pairs):
        made.append(pairs.count())
        return measure(self, pairs)

    monkeypatch.setattr(jaccard.JaccardJoin, "_measure", counting)
    found = jaccard.jaccard_components(frame(spark, rows), jaccard.Similarity(4, 85))
    assert counted(found.select("doc_id", "n_shingles", "component_id").collect()) == (
        expected_components(rows, 4, 85)
    )
    assert sum(made) < 30 * len(rows)


def test_one_of_each(spark):
    rows = documents()
    kept = jaccard.one_of_each(frame(spark, rows, clashes=True), jaccard.Similarity(5, 80))
    got = kept.select("doc_id", "text").collect()
    wordless = [r for r in rows if not (r[1] or "").split()]
    groups = {c for _, n, c in expected_components(rows, 5, 80) if n}
    assert sum(1 for r in got if not (r[1] or "").split()) == len(wordless)
    assert {r[0] for r in got if (r[1] or "").split()} == groups
    assert kept.columns == frame(spark, rows, clashes=True).columns
    assert jaccard.one_of_each(empty(spark), jaccard.Similarity()).count() == 0


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(60)]
    rng.shuffle(chain)
    edges = chain + [(100, 200), (200, 300), (7, 7)] + [(1000, 1000 + i) for i in range(1, 50)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = dict(tuple(r) for r in components(df, Scratch(spark, "test")).collect())
    assert found == {
        **{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100,
        **{1000 + i: 1000 for i in range(50)},
    }


def test_class_difference_is_a_bound():
    rng = np.random.default_rng(4)
    for n, m, common in ((10, 12, 8), (900, 1100, 700), (5000, 4000, 3000), (40_000, 70_000, 9000)):
        x, y = (rng.integers(0, 1 << 63, k).astype(np.uint64) for k in (n, m))
        y[:common] = x[:common]
        apart = len(np.setxor1d(x, y))
        found = jaccard.class_difference(jaccard.class_counts(x), jaccard.class_counts(y))
        assert found <= apart
        same = jaccard.class_difference(jaccard.class_counts(x), jaccard.class_counts(x))
        assert same == 0
    # All in one class: counts that stop at 255 must not look apart.
    one, two = np.full(70_000, 5, np.uint64), np.full(900, 5, np.uint64)
    assert jaccard.class_difference(jaccard.class_counts(one), jaccard.class_counts(two)) == 0
