"""Toxicity, quality, neighbours, mixing, quotations and the pipeline."""

import collections
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from cases import documents, empty, frame, words
from salesmart.llm import mixing, neighbours, quality, quotes, toxicity
from salesmart.llm.logistic import fit_logistic, sigmoid
from salesmart.llm.shared import Rolling

SMALL = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def plain_segments(scores):
    """The definition: the best stretch, then the same to its left and to its right."""
    out = []

    def search(a, b):
        best = (0.0, 0, 0)
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > best[0] + 1e-12:
                    best = (total, i, j + 1)
        if best[0] > 0:
            search(a, best[1])
            out.append(best[1:])
            search(best[2], b)

    search(0, len(scores))
    return out


def test_maximal_scoring_segments():
    rng = random.Random(1)
    for _ in range(800):
        scores = [rng.choice([-3, -2, -1, 1, 2, 3]) + rng.random() / 100 for _ in range(rng.randint(0, 14))]
        assert [s[:2] for s in toxicity.segments(np.array(scores))] == plain_segments(scores)


def labelled(spark):
    """Documents of which every fourth has a passage of bad words."""
    rng, rows, labels = random.Random(4), [], []
    for i in range(400):
        text = words(rng, 60)
        bad = i % 4 == 0
        if bad:
            text[20:23] = [f"vile{rng.choice('abcde')}{rng.choice('xyz')}" for _ in range(3)]
        junk = i % 5 == 0
        rows.append((i, ("%% | " if junk else " ").join(text), rng.choice(["en", None]), f"s{i % 3}", 0))
        labels.append((i, int(not junk), int(bad)))
    labels += [(0, None, None), (1, 1, 0), (1, 1, 0), (None, 1, 1), (9999, 0, 1)]
    return frame(spark, rows), spark.createDataFrame(labels, LABELS), rows


def test_toxic_passages_are_found(spark):
    docs, labels, rows = labelled(spark)
    model = toxicity.fit(docs, labels)
    found = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    held = [i for i in found if found[i].held_out]
    assert 50 < len(held) < 110
    right = sum(found[i].predicted == (i % 4 == 0) for i in held)
    assert right >= 0.95 * len(held)
    caught = [i for i in held if i % 4 == 0 and found[i].passages]
    assert caught
    for i in caught:
        spans = [rows[i][1].lower().encode()[p.begin : p.end].decode() for p in found[i].passages]
        assert any("vile" in s for s in spans) and all(p.expected < 0.05 for p in found[i].passages)
    odd = toxicity.score_documents(frame(spark, clashes=True), model).collect()
    assert len(odd) == len(documents()) and all(0 <= r.score <= 1 for r in odd)
    kept = toxicity.without_toxic(frame(spark, clashes=True), model)
    assert kept.columns == frame(spark, clashes=True).columns and kept.count() > 0
    assert {r.doc_id for r in toxicity.without_toxic(docs, model).collect()} == {
        i for i in found if not found[i].predicted
    }


def test_words_that_share_low_bits_of_a_hash(spark):
    """A toxic word is not hidden by a frequent clean one, whatever their hashes are."""
    rng, seen = random.Random(12), {}
    while True:
        word = "".join(rng.choices("bcdfghklmnprstvz", k=9))
        data = np.frombuffer(word.encode(), np.uint8)
        low = int(Rolling(data).hashes(np.array([0]), np.array([9]))[0] % np.uint64(1 << 19))
        if low in seen and seen[low][:4] != word[:4]:
            break
        seen[low] = word
    vile, fine, rows, labels = word, seen[low], [], []
    for i in range(400):
        text = words(rng, 60)
        text[20:20] = [vile] * 3 if i % 4 == 0 else [fine] * 5
        rows.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = frame(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, LABELS))
    found = toxicity.score_documents(docs, model).where("held_out").collect()
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in found) >= 0.95 * len(found)


def test_rare_tokens_are_joined(spark, monkeypatch):
    """Scores do not depend on how many counts go to every task."""
    docs, labels, _ = labelled(spark)
    docs = docs.unionByName(frame(spark)).unionByName(docs.limit(3))
    whole = toxicity.fit(docs, labels)
    monkeypatch.setattr(toxicity, "HEAD", 40)
    part = toxicity.fit(docs, labels)
    assert whole.counts is None and part.counts is not None and len(part.keys) <= 40
    one, two = (
        sorted((r.doc_id or -1, r.tokens, round(r.score, 9), str(r.passages)[:80])
               for r in toxicity.score_documents(docs, m).collect()) for m in (whole, part)
    )
    assert [r[:3] for r in one] == [r[:3] for r in two]
    kept = [toxicity.without_toxic(docs, m).select("doc_id").collect() for m in (whole, part)]
    assert collections.Counter(kept[0]) == collections.Counter(kept[1])


def test_toxicity_without_labels(spark):
    model = toxicity.fit(empty(spark), spark.createDataFrame([], LABELS))
    assert toxicity.score_documents(empty(spark), model).count() == 0
    assert all(r.predicted == 0 for r in toxicity.score_documents(frame(spark), model).collect())


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels, _ = labelled(spark)
    flipped = labels.selectExpr(
        "doc_id", "quality", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - toxic, toxic) toxic"
    )
    one, two = (toxicity.fit(docs, x) for x in (labels, flipped))
    assert (one.toxic == two.toxic).all() and np.allclose(one.weights, two.weights)


def test_quality(spark):
    docs, labels, _ = labelled(spark)
    model = quality.fit(docs, labels)
    found = quality.score_documents(docs, model).where("held_out").collect()
    assert sum(r.kept == (r.doc_id % 5 != 0) for r in found) >= 0.95 * len(found)
    odd = quality.score_documents(frame(spark, clashes=True), model).collect()
    assert len(odd) == len(documents()) and all(0 <= r.score <= 1 for r in odd)
    flat = quality.fit(empty(spark), spark.createDataFrame([], LABELS))
    assert all(r.kept for r in quality.score_documents(frame(spark), flat).collect())
    assert quality.score_documents(empty(spark), flat).count() == 0


def test_views_teach_each_other():
    """Few labels, two views that are each enough, and a pool: both views get better."""
    rng = np.random.default_rng(3)

    def draw(n):
        y = rng.integers(0, 2, n)
        views = [rng.normal(size=(n, 20)) for _ in range(2)]
        for v in views:
            v[:, :10] += np.where(y, 0.9, -0.9)[:, None]
        return views[0], views[1], y.astype(float)

    a, b, y = draw(40)
    pool, test = draw(3000), draw(2000)
    held = np.arange(40) >= 24
    alone = quality.co_train(a, b, y, held, pool[0][:0], pool[1][:0], quality.Training())
    taught = quality.co_train(a, b, y, held, pool[0], pool[1], quality.Training())

    def right(view, x):
        return ((view.margin(x) > 0) == (test[2] > 0)).mean()

    assert right(taught.content, test[0]) > right(alone.content, test[0])
    assert right(taught.page, test[1]) > right(alone.page, test[1])


def test_logistic_fit():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(5000, 3))
    y = (rng.random(5000) < sigmoid(1 + x @ np.array([2.0, -1.0, 0.0]))).astype(float)
    assert np.allclose(fit_logistic(x, y), [1, 2, -1, 0], atol=0.2)
    assert np.isfinite(fit_logistic(x, np.ones(5000))).all()


VECTORS = "vec_id long, embedding array<float>, score string, rank string"


def test_nearest(spark):
    """Every probe of every bucket is an exhaustive search; fewer find most."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=8) * rng.uniform(0.2, 3)], "x", "x") for i in range(300)]
    rows += [(i, rows[7][1], "x", "x") for i in range(300, 340)]  # ties
    bad = [None, [], [0.0] * 8, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7]
    rows += [(400 + i, v, "x", "x") for i, v in enumerate(bad)] + [(None, rows[0][1], "x", "x"), rows[3]]
    df = spark.createDataFrame(rows, VECTORS)
    asked = df.where("vec_id % 20 = 0")
    good = {r[0]: np.float32(r[1]).astype(float) for r in rows[:340]}
    ids = np.array(sorted(good))
    table = np.stack([good[i] for i in ids])
    exact = {}
    for q in ids[ids % 20 == 0]:
        score = (table * good[q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        exact[int(q)] = [(int(ids[i]), float(score[i])) for i in order]

    def found(probing):
        out = collections.defaultdict(list)
        for r in neighbours.nearest(df, asked, probing).orderBy("query_id", "rank").collect():
            out[r.query_id].append((r.vec_id, r.score))
        return out

    everything = neighbours.Probing(tables=1, hashes=1, probes=3, width=40.0, part_rows=50)
    assert found(everything) == exact
    usual = found(neighbours.Probing())
    hits = [len({i for i, _ in usual[q]} & {i for i, _ in exact[q]}) / 20 for q in exact]
    assert np.mean(hits) >= 0.9
    assert neighbours.nearest(df.limit(0), asked.limit(0), everything).count() == 0


def test_nearest_of_unequal_norms_and_small_tables(spark):
    """20 rows a query, or all candidates, and true ones, whatever the lengths are."""
    rng = np.random.default_rng(8)
    unit = rng.normal(size=(900, 32))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    outlier = unit.copy()
    outlier[5] *= 1000
    spread = unit * 2.0 ** rng.integers(-3, 4, 900)[:, None]
    for table, asked in ((outlier, 40), (spread, 40), (unit[:15], 15), (unit[:20], 20), (unit[:1], 1)):
        rows = [(i, [float(x) for x in v], "x", "x") for i, v in enumerate(table)]
        df = spark.createDataFrame(rows, VECTORS)
        found = collections.defaultdict(set)
        for r in neighbours.nearest(df, df.where(f"vec_id < {asked}"), neighbours.Probing()).collect():
            found[r.query_id].add(r.vec_id)
        size = min(20, len(table) - 1)
        scores = np.float32(table[:asked]).astype(float) @ np.float32(table).astype(float).T
        np.fill_diagonal(scores, -np.inf)
        best = np.argsort(-scores, axis=1)[:, :size]
        assert all(len(found[q]) == size for q in range(asked))
        hits = [len(found[q] & set(best[q])) for q in range(asked)]
        assert sum(hits) >= 0.9 * size * asked


def test_nearest_holds_bounded_groups(spark, tmp_path, monkeypatch):
    """No group has many more queries or vectors than a part, even of one bucket."""
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=8)], "x", "x") for i in range(600)]
    df, ranked = spark.createDataFrame(rows, VECTORS), neighbours._ranked
    folder = str(tmp_path)

    def watched(probing):
        run = ranked(probing)

        def see(queries, vectors):
            import pathlib
            import uuid

            name = f"{len(queries)}-{len(vectors)}-{uuid.uuid4().hex}"
            (pathlib.Path(folder) / name).touch()
            return run(queries, vectors)

        return see

    monkeypatch.setattr(neighbours, "_ranked", watched)
    one_bucket = neighbours.Probing(tables=1, hashes=1, probes=3, width=40.0, part_rows=50)
    assert neighbours.nearest(df, df, one_bucket).count() == 600 * 20
    sizes = [tuple(map(int, p.name.split("-")[:2])) for p in tmp_path.iterdir()]
    assert max(q for q, _ in sizes) < 120 and max(v for _, v in sizes) < 120


def entropy(tokens, tau):
    w = np.array(tokens, float) ** tau
    w /= w.sum()
    return -(w * np.log(w)).sum()


def test_exponent(spark):
    tokens = [9000, 500, 300, 200]
    sources = spark.createDataFrame(
        [(f"s{i}", 1, t, t / 10_000) for i, t in enumerate(tokens)],
        "source string, documents long, tokens long, share double",
    )
    tau = mixing.find_exponent(sources, mixing.Target(entropy=1.0))
    assert entropy(tokens, tau) == pytest.approx(1.0, abs=1e-6)
    tau = mixing.find_exponent(sources, mixing.Target(repetitions=3.0))
    assert (9000 / 200) ** (1 - tau) == pytest.approx(3.0, abs=1e-6)
    assert mixing.find_exponent(sources, mixing.Target(repetitions=100.0)) == 0
    with pytest.raises(ValueError):
        mixing.Target()


def test_mixing(spark):
    rng = random.Random(2)
    sizes = {"big": 1200, "mid": 200, None: 60}
    rows = [(i, " ".join(words(rng, rng.randint(1, 30))), "en", s, 0)
            for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = frame(spark, rows, clashes=True)
    out = mixing.mix(docs, mixing.Target(repetitions=3.0)).select(
        "doc_id", "source", "tokens", "weight", "pass_number", "slot").collect()
    assert {r.doc_id for r in out} == set(range(len(rows)))  # none is left out
    assert len({(r.doc_id, r.pass_number) for r in out}) == len(out)
    taken, once = collections.Counter(), collections.Counter()
    for r in out:
        taken[r.source] += r.tokens
        once[r.source] += r.tokens if r.pass_number == 0 else 0
    weights = {r.source: r.weight for r in out}
    total = sum(taken.values())
    for source in sizes:
        assert taken[source] / total == pytest.approx(weights[source], abs=0.01)
        assert 0.99 <= taken[source] / once[source] <= 3.0
    assert taken[None] / once[None] > 2.9
    # Any stretch of slots has about the weights of the whole.
    half = collections.Counter()
    for r in out:
        assert 0 <= r.slot < 1
        half[r.source] += r.tokens if r.slot < 0.5 else 0
    assert half["big"] / sum(half.values()) == pytest.approx(weights["big"], abs=0.05)
    budget = mixing.mix(docs, mixing.Target(repetitions=50.0, budget=4000)).collect()
    assert 3500 <= sum(r.tokens for r in budget) <= 4000
    odd = mixing.mix(frame(spark, clashes=True), mixing.Target(repetitions=1.0))
    assert odd.count() == len(documents())
    assert mixing.mix(empty(spark), mixing.Target(entropy=0.5)).count() == 0


MESSAGES = "conv_id long, turn long, role string, text string"


def test_quotations(spark):
    rows = [
        (1, 0, "u", "How do I\nfix a pump?"), (1, 1, "a", "Turn it off.\nThen on."),
        (1, 2, "u", "On Monday x wrote:\n> turn it  OFF.\n> > How do I\nThat failed."),
        (1, 3, "a", "> That failed.\n>> turn it off.\nSorry"), (1, 4, "u", "new topic"),
        (1, 5, "u", "> That failed.\n> > Then on.\nmore\n\n> new topic\nend"), (2, 0, "u", None),
        (2, 1, "a", "> How do I\nhm"), (2, 2, "a", "> hm\n> unknown\n"), (None, 0, "u", "x"),
        (None, None, "u", "> x\ny"), (2, 0, "u", None), (3, 0, "u", "> later\n"), (3, 1, "u", "later"),
    ]
    found = quotes.link_replies(spark.createDataFrame(rows, MESSAGES).repartition(2))
    got = collections.Counter(
        (r.conv_id, r.turn, r.text, r.parent_turn, r.root_turn, r.depth) for r in found.collect()
    )
    assert got == collections.Counter([
        (1, 0, "How do I\nfix a pump?", None, 0, 0), (1, 1, "Turn it off.\nThen on.", None, 1, 0),
        (1, 2, "That failed.", 1, 1, 1), (1, 3, "Sorry", 2, 1, 2), (1, 4, "new topic", None, 4, 0),
        (1, 5, "more\n\nend", 2, 1, 2), (2, 0, "", None, 0, 0), (2, 0, "", None, 0, 0),
        (2, 1, "hm", None, 1, 0), (2, 2, "", 1, 1, 1), (None, 0, "x", None, 0, 0),
        (None, None, "y", 0, 0, 1), (3, 0, "", None, 0, 0), (3, 1, "later", None, 1, 0),
    ])
    chain = [(9, i, "u", f"> line {i - 1}\nline {i}") for i in range(40)]
    deep = quotes.link_replies(spark.createDataFrame(chain, MESSAGES)).orderBy("turn").collect()
    assert [(r.depth, r.root_turn) for r in deep] == [(i, 0) for i in range(40)]
    assert quotes.link_replies(spark.createDataFrame([], MESSAGES)).count() == 0


def test_quotations_wrapped_anew(spark):
    """Passages are found whatever their line ends, and before short lines in them."""
    long = "the valve of the old pump was never closed and the tank ran empty over night"
    rows = [
        (1, 0, "u", "yes"), (1, 1, "a", f"Hello\n{long}\nyes"), (1, 2, "u", "first part of it\nand its second part"),
        # One line as two, two as one, a part of a line as two, a whole passage with a short line.
        (1, 3, "u", "> the valve of the old pump was never closed\n> and the tank ran empty over night\nA"),
        (1, 4, "u", "> First part of it and its  second part\nB"),
        (1, 5, "u", "> old pump was never closed and\n> the tank ran empty\nC"),
        (1, 6, "u", f"> Hello {long}\n> yes\nD"), (1, 7, "u", "> yes\nE"), (1, 8, "u", "> nobody\n> said so\nF"),
    ]
    found = quotes.link_replies(spark.createDataFrame(rows, MESSAGES).repartition(2)).collect()
    assert {r.turn: r.parent_turn for r in found} == {
        0: None, 1: None, 2: None, 3: 1, 4: 2, 5: 1, 6: 1, 7: 0, 8: None,
    }
    assert {r.turn: r.text for r in found}[6] == "D"


def test_pipeline_stages(spark):
    """Every stage keeps the columns, and takes only what its operator decides."""
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing",
    ]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).persist()
        count = docs.count()
        assert docs.columns == columns
        assert count >= before if name.startswith("mixing") else 0.85 * before < count <= before
        before = count
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.where("start = 0").count() == before


def test_filter_of_rare_counts_misses_none(spark, monkeypatch):
    """Every word with counts outside the arrays is looked up, and few others are."""
    docs, labels, _ = labelled(spark)
    monkeypatch.setattr(toxicity, "HEAD", 40)
    model = toxicity.fit(docs, labels)
    table = model.counts.where("kind = 0").toPandas()
    keys = np.array([table["key"].to_numpy()] * 3)
    outside = ~model.places(0, keys[0])[1]
    assert outside.sum() > 100 and (model.unsure(keys) == outside).all()
    strange = np.random.default_rng(5).integers(-(1 << 62), 1 << 62, (3, 10_000))
    assert model.unsure(strange).mean() < 0.01


def test_rounds_over_a_table_are_those_over_arrays(spark):
    """Co-training over all rows of a table, and over the same rows as arrays, by definition."""
    docs, labels, rows = labelled(spark)
    rng = random.Random(31)
    more = []
    for i in range(1000, 2500):
        junk = i % 5 == 0
        text = ("%% | " if junk else " ").join(words(rng, 40))
        more.append((i, text, "de" if junk else "en", f"s{i % 3}", None if i % 7 == 0 else len(text)))
    docs = docs.unionByName(frame(spark, more))
    training = quality.Training(rounds=3)
    model = quality.fit(docs, labels, training)
    known = {r[0]: r[1] for r in labels.where("quality IS NOT NULL").collect()}
    kept = [r for r in rows + more if zlib.crc32(str(r[0]).encode()) % 5 != 0]
    lists = []
    for part in ([r for r in kept if r[0] in known], [r for r in kept if r[0] not in known]):
        content = np.array([quality.content_features(r[1].encode()) for r in part], "<f4").astype(float)
        page = np.array([quality.page_features(*r[2:5]) for r in part], "<f4").astype(float)
        lists.append((content, page))
    y = np.array([known[r[0]] for r in kept if r[0] in known], float)
    held = np.array([zlib.crc32(str(r[0]).encode()) % 5 == 4 for r in kept if r[0] in known])
    plain = quality.co_train(*lists[0], y, held, *lists[1], training)
    assert len(lists[1][0]) > 1000
    for a, b in ((model.content, plain.content), (model.page, plain.page)):
        assert np.allclose(a.weights, b.weights, atol=1e-6) and np.allclose(a.mean, b.mean)
    assert np.allclose(model.combine, plain.combine, atol=1e-6)


def test_thresholds_take_sure_ends_only():
    middle, rng = quality.REACH * quality.STEPS, np.random.default_rng(2)
    margins = rng.normal(0, 4, 5000)
    counts = np.bincount(np.floor(margins * quality.STEPS).astype(int) + middle, minlength=2 * middle + 1)
    low, high = quality.thresholds(counts, 100, 200, 0.5)
    assert 100 <= (margins < (low + 1) / quality.STEPS).sum() < 120
    assert 200 <= (margins >= high / quality.STEPS).sum() < 220
    # A view that says the same of every row teaches nothing, whatever the share of good labels.
    flat = np.zeros(2 * middle + 1, int)
    flat[middle + int(2.2 * quality.STEPS)] = 5000
    low, high = quality.thresholds(flat, 100, 200, 0.9)
    assert flat[: low + middle + 1].sum() == 0 and flat[high + middle :].sum() == 0


def test_nearest_with_components_of_any_size(spark):
    """Components whose squares overflow or vanish take part and hide no other vector."""
    rng = np.random.default_rng(13)
    table = rng.normal(size=(700, 12))
    table[3] *= 1e200
    table[650] *= 1e-200
    table[40], table[80] = 1e300, -1e300
    rows = [(i, [float(x) for x in v], "x", "x") for i, v in enumerate(table)]
    df = spark.createDataFrame(rows, VECTORS.replace("float", "double"))
    found = collections.defaultdict(list)
    asked = [0, 3, 20, 40, 650]
    queries = df.where(f"vec_id IN ({', '.join(map(str, asked))})")
    for r in neighbours.nearest(df, queries, neighbours.Probing(hashes=1, probes=3, width=40.0)).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    for q in asked:
        with np.errstate(over="ignore", invalid="ignore"):
            score = (table * table[q]).sum(axis=1)
        score = np.where(np.isnan(score), -np.inf, score)
        best = [i for i in np.lexsort((np.arange(700), -score)) if i != q][:20]
        assert [i for _, i, _ in sorted(found[q])] == best
