"""Spelling variants grouped by a trie of letter counts (operator 11).

A word is a path of counts: how many letters of the first group it has, of the second, and
so on. An edit of one letter moves at most one letter into a count (a surplus of one) and
one out of another (a deficit of one), so the words near a word lie on few paths.

1. Tasks count the words of their texts and merge them, so the shuffle carries vocabularies.
2. The upper levels of the trie are walked by joins: every word visits the nodes its budget
   allows, one level a round. A node of at most ``node_words`` words is left to one task;
   larger ones are opened further. The surplus is spent before the deficit, so a pair of
   words is met from its shorter (or, on its path, smaller) side only.
3. A task builds the rest of the trie below its node and walks it depth first for its
   visitors. Leaves index their words by halves: one edit leaves one half as it is. Those
   words are verified letter by letter.
4. A leaf of more than ``node_words`` words does not go to a task: its words are joined
   with their visitors by halves.
"""

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.shared import LOWER, Scratch, plain_text

# The letters of words after A-Z became a-z: a-z and U+00C0 to U+00FF (two bytes in UTF-8).
RUN = re.compile(rb"(?:[a-z]++|(?:\xc3[\x80-\xbf])++)++")
_LOWER = LOWER.tobytes()
# a-z from frequent to rare, so that dealing them in turn gives groups of like weight.
LETTERS = "etaoinshrdlcumwfgypbvkjxqz" + "".join(map(chr, range(0xC0, 0x100)))
MOST_COUNTED = 200_000  # words a task holds before it passes their counts on


@dataclass(frozen=True)
class Spelling:
    least_length: int = 7  # in code points
    least_count: int = 2
    dominance: int = 10  # a form is at least so many times as frequent
    damage: int = 31  # one run of so many loses a letter; 0: none
    groups: int = 8
    first_depth: int = 3
    node_words: int = 20_000  # words of a node, and its visitors, in one task


# Words ------------------------------------------------------------------------------------


def text_words(key: str, text: bytes, rules: Spelling) -> Iterator[tuple[bytes, int]]:
    """Words of one text with their occurrences; ``key`` is the document's id as text."""
    least = rules.least_length
    start = zlib.crc32(f"{key}:".encode())
    runs = Counter(r for r in RUN.findall(text.translate(_LOWER)) if len(r) >= least)
    for run, times in runs.items():
        mark = zlib.crc32(run, start)
        if rules.damage and mark % rules.damage == 0:
            letters = run.decode()
            at = mark % len(letters)
            run = (letters[:at] + letters[at + 1 :]).encode()
        if len(run) >= least and (run.isascii() or len(run.decode()) >= least):
            yield run, times


def _count(rules: Spelling):
    def flushed(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode() for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                for word, times in text_words(key.as_py(), text.as_py().encode(), rules):
                    counts[word] += times
                if len(counts) > MOST_COUNTED:
                    yield flushed(counts)
                    counts.clear()
        yield flushed(counts)

    return run


def count_words(docs: DataFrame, rules: Spelling) -> DataFrame:
    """(word, n) of the whole table."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), plain_text().alias("text")
    )
    return (
        rows.mapInArrow(_count(rules), "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= rules.least_count)
    )


# The upper levels -------------------------------------------------------------------------


def letter_counts(rules: Spelling) -> Column:
    """The path of a word: its letters of each group, as ``2.0.1...``."""
    counts = []
    for group in range(rules.groups):
        letters = LETTERS[group :: rules.groups]
        counts.append(F.char_length("word") - F.char_length(F.translate("word", letters, "")))
    return F.concat_ws(".", *[c.cast("string") for c in counts])


# What has been spent on the way: nothing, the surplus, the surplus and then the deficit.
_MOVES = {0: ((0, 0), (1, 1)), 1: ((0, 1), (-1, 2)), 2: ((0, 2),)}


def _deviations(depth: int) -> list[tuple[list[int], int]]:
    """All changes of the first ``depth`` counts that the budget allows, and what they spend."""
    found = [([], 0)]
    for _ in range(depth):
        found = [([*d, step], after) for d, spent in found for step, after in _MOVES[spent]]
    return found


def _node(path: str, depth: int) -> Column:
    return F.substring_index(path, ".", depth)


def _first_visits(words: DataFrame, depth: int) -> DataFrame:
    counts = F.split("path", "\\.")
    made = []
    for steps, spent in _deviations(depth):
        parts = [(F.get(counts, F.lit(i)).cast("int") + step).cast("string") for i, step in enumerate(steps)]
        made.append(F.struct(F.concat_ws(".", *parts).alias("node"), F.lit(spent).alias("spent")))
    return words.select("word", "n", "path", F.inline(F.array(*made)))


def _deeper(visits: DataFrame, depth: int) -> DataFrame:
    """Visits of opened nodes, one level further down."""
    count = F.get(F.split("path", "\\."), F.lit(depth - 1)).cast("int")

    def moves(spent: int) -> Column:
        return F.array(*[
            F.struct(
                F.concat_ws(".", "node", (count + step).cast("string")).alias("node"),
                F.lit(after).alias("spent"),
            )
            for step, after in _MOVES[spent]
        ])

    chosen = F.when(F.col("spent") == 0, moves(0)).when(F.col("spent") == 1, moves(1)).otherwise(moves(2))
    opened = visits.withColumn("moves", chosen).select("word", "n", "path", F.explode("moves").alias("m"))
    return opened.select("word", "n", "path", "m.node", "m.spent")


def _routed(words: DataFrame, rules: Spelling, scratch: Scratch):
    """Members and visitors of the nodes left to tasks, and those of leaves too large for it."""
    small, depth, members = [], rules.first_depth, words
    visits = _first_visits(words, depth)
    while True:
        last = depth == rules.groups
        placed = members.withColumn("node", _node("path", depth))
        sizes = scratch.write(placed.groupBy("node").agg(F.count("*").alias("size")), f"sizes{depth}")
        visits = scratch.write(visits.join(sizes, "node"), f"visits{depth}")
        fits = F.col("size") <= rules.node_words
        placed = placed.join(sizes, "node")
        small.append((placed.where(fits), visits.where(fits)))
        if sizes.where(~fits).isEmpty():
            return small, None
        members, visits = placed.where(~fits).drop("size"), visits.where(~fits)
        if last:
            return small, (members, visits)
        members, depth = members.drop("node"), depth + 1
        visits = _deeper(visits, depth)


# Below a node -----------------------------------------------------------------------------


def one_edit(a: str, b: str) -> bool:
    """Whether ``b`` is ``a`` with one letter replaced, or with one more."""
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) == len(b):
        return at < len(a) and a[at + 1 :] == b[at + 1 :]
    return a[at:] == b[at + 1 :]


class Leaf:
    """Words of one path, and so of one length, found by halves."""

    def __init__(self):
        self.words: list[tuple[str, int]] = []
        self._halves: dict[int, dict] = {}

    def near(self, word: str, spent: int) -> list[tuple[str, int]]:
        length = len(word)
        if length not in self._halves:
            index = self._halves[length] = defaultdict(list)
            for entry in self.words:
                index[True, entry[0][: length // 2]].append(entry)
                index[False, entry[0][length // 2 - length :]].append(entry)
        index, half = self._halves[length], length // 2
        found = {*index.get((True, word[:half]), ()), *index.get((False, word[half - length :]), ())}
        # Words of the visitor's own path are met from both sides: once is enough.
        return [e for e in found if one_edit(word, e[0]) and (spent or word < e[0])]


class Trie:
    """Counts below a node, as nested dictionaries down to leaves."""

    def __init__(self, depth: int, groups: int):
        self._depth, self._groups, self._root, self._walks = depth, groups, {}, {}

    def _counts(self, path: str) -> list[int]:
        return [int(c) for c in path.split(".")[self._depth :]]

    def add(self, word: str, n: int, path: str) -> None:
        node, counts = self._root, self._counts(path)
        for count in counts[:-1]:
            node = node.setdefault(count, {})
        last = counts[-1] if counts else 0
        node.setdefault(last, Leaf()).words.append((word, n))

    def leaves(self, path: str, spent: int) -> list[tuple[Leaf, int]]:
        """The leaves that the rest of the budget reaches, each with all that was spent."""
        key = path, spent
        if key not in self._walks:
            counts = self._counts(path)
            found = self._walks[key] = []
            if not counts:  # the node itself is a leaf
                found += [(leaf, spent) for leaf in self._root.values()]
            else:
                self._descend(self._root, counts, 0, spent, found)
        return self._walks[key]

    def _descend(self, node, counts, level, spent, found) -> None:
        if level == len(counts):
            found.append((node, spent))
            return
        for step, after in _MOVES[spent]:
            child = node.get(counts[level] + step)
            if child is not None:
                self._descend(child, counts, level + 1, after, found)


PAIRS = "word string, n long, other string, other_n long"


def _below(groups: int):
    def pairs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        trie = Trie(key[0].count(".") + 1, groups)
        member = rows["spent"] < 0
        for r in rows[member].itertuples(index=False):
            trie.add(r.word, r.n, r.path)
        found = []
        for r in rows[~member].itertuples(index=False):
            for leaf, spent in trie.leaves(r.path, r.spent):
                found += [(r.word, r.n, *e) for e in leaf.near(r.word, spent)]
        return pd.DataFrame(found, columns=["word", "n", "other", "other_n"])

    return pairs


def _pairs_in_tasks(members: DataFrame, visits: DataFrame, rules: Spelling) -> DataFrame:
    """Pairs below small nodes: visitors in parts, members copied to each part."""
    many = visits.groupBy("node").agg(F.count("*").alias("visits"))
    parts = many.select("node", F.ceil(F.col("visits") / rules.node_words).alias("parts"))
    inside = members.join(parts, "node").select(
        "node", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        "word", "n", "path", F.lit(-1).alias("spent"),
    )
    part = F.pmod(F.xxhash64("word", "spent"), "parts")
    outside = visits.join(parts, "node").select("node", part.alias("part"), "word", "n", "path", "spent")
    return inside.unionByName(outside).groupBy("node", "part").applyInPandas(_below(rules.groups), PAIRS)


def _pairs_by_halves(members: DataFrame, visits: DataFrame) -> DataFrame:
    """Pairs in leaves of any size: a join on the half that an edit leaves as it is."""
    length = F.char_length("word") - F.when(F.col("spent") == 1, 1).otherwise(0)
    half = F.expr("floor(length / 2)").cast("int")
    first, rest = F.expr("substring(word, 1, half)"), F.expr("right(word, length - half)")

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("length", length).withColumn("half", half).withColumn(
            "key", F.explode(F.array(F.concat(F.lit("<"), first), F.concat(F.lit(">"), rest)))
        )

    # A member stands for visitors of its own length, and for those one letter shorter.
    roles = members.withColumn("spent", F.explode(F.array(*map(F.lit, range(3)))))
    inside = keyed(roles).select("node", "spent", "key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    outside = keyed(visits.withColumn("spent_as", F.col("spent")).withColumn("spent", F.lit(0)))
    outside = outside.select("node", F.col("spent_as").alias("spent"), "key", "word", "n")
    near = (F.levenshtein("word", "other", 1) == 1) & ((F.col("spent") > 0) | (F.col("word") < F.col("other")))
    return outside.join(inside, ["node", "spent", "key"]).where(near).select("word", "n", "other", "other_n").distinct()


def near_pairs(words: DataFrame, rules: Spelling, scratch: Scratch) -> DataFrame:
    """(word, n, other, other_n): every two words one edit apart, once."""
    placed = scratch.write(words.withColumn("path", letter_counts(rules)), "words")
    small, large = _routed(placed, rules, scratch)
    members, visits = (reduce(DataFrame.unionByName, side) for side in zip(*small))
    pairs = _pairs_in_tasks(members, visits, rules)
    if large is not None:
        pairs = pairs.unionByName(_pairs_by_halves(*large))
    return scratch.write(pairs, "pairs")


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root): the end of each chain of forms, in steps that double.

    A form is far more frequent than its word, so chains have no circles and few members.
    """
    step = 0
    links = scratch.write(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "links0")
    while not links.where("moved").isEmpty():
        step += 1
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = scratch.write(
            links.join(further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            f"links{step}",
        )
    return links.select("word", "root")


def spelling_variants(docs: DataFrame, rules: Spelling = Spelling()) -> DataFrame:
    """One row per word: its more frequent form, the last of its forms, and its near words.

    word, form, root, n, n_near, form_n. Words are runs of letters of whole texts, in lower
    case (A-Z only), of at least ``least_length`` code points and ``least_count``
    occurrences; in one run of ``damage`` a letter is left out, chosen by document and run.
    Two words are near if one inserted, deleted or replaced letter turns one into the other.
    The form is the most frequent near word (ties: the smallest in code points), if it is
    ``dominance`` times as frequent.

    Null and empty texts have no words; a null doc_id counts as the empty text where a run's
    letter is chosen. Very long texts and runs are read whole. Repeated rows count again.
    Further columns are ignored; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "variants")
    words = scratch.write(count_words(docs, rules), "counted")
    pairs = near_pairs(words, rules, scratch)
    swapped = pairs.select(
        F.col("other").alias("word"), F.col("other_n").alias("n"),
        F.col("word").alias("other"), F.col("n").alias("other_n"),
    )
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = pairs.unionByName(swapped).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    most = -F.col("best.less")
    strong = most >= rules.dominance * F.col("n")
    near = scratch.write(
        near.select(
            "word", "n_near", F.when(strong, F.col("best.other")).alias("form"),
            F.when(strong, most).alias("form_n"),
        ),
        "near",
    )
    roots = _roots(near.where("form IS NOT NULL"), scratch)
    return words.join(near, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
    )
