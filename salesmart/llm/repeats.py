"""Repeated substrings deleted by refined suffix buckets (operator 12).

Suffixes are compared as far as ``window`` bytes go: a window is deleted if the same bytes
start earlier. Names of all suffixes would be many times the input, so suffixes are sampled
where their content says so: every window holds an anchor, the place of its smallest hashed
q-gram, and equal windows hold it at the same offset.

1. The q-grams of anchors are the initial buckets. Buckets of one anchor hold no repeat and
   go at once; only repeated ones keep their anchors.
2. An anchor's context is all bytes of the windows around it. Anchors of a bucket with one
   and the same context are one entry: later ones are deleted with all their windows.
3. The first anchors of different contexts are refined: their suffixes, one for each window
   around the anchor, start in buckets of short grams and are sorted on the bucket pointers
   of later offsets. Refined pointers are the sort keys of the next round, which doubles the
   compared length, until it is that of the window; suffixes alone in a bucket drop out.
4. A bucket of more than ``bucket_anchors`` contexts is first split by halves of the window
   range: windows that start left of the middle share all bytes right of it, and the other
   way round. The halves are buckets of longer strings; they split again while too large.
5. Deleted stretches go to their texts, which are cut and hashed.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.shared import PIECE_BYTES, Rolling, Scratch, plain_text, row_hashes


@dataclass(frozen=True)
class Repeats:
    window: int = 100  # bytes: shortest repeat that is deleted
    gram: int = 32  # bytes of the initial buckets, less than the window
    bucket_anchors: int = 10_000  # contexts of a bucket refined by one task

    @property
    def reach(self) -> int:
        """Bytes before, and after, an anchor's gram that its windows may hold."""
        return self.window - self.gram


# Anchors ----------------------------------------------------------------------------------


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of ``width`` values from each place on, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def _anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places of values that are the smallest of some ``width`` in a row, all ties included."""
    least = _smallest(hashes, width)
    # A place is an anchor if one of the stretches over it has its value as the smallest.
    pad = np.zeros(width - 1, np.uint64)
    largest = ~_smallest(~np.concatenate([pad, least, pad]), width)
    return np.flatnonzero(hashes == largest)


def text_anchors(text: bytes, rules: Repeats) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, gram hashes, context hashes) of a text's anchors, piece by piece."""
    width, reach = rules.reach + 1, rules.reach
    if len(text) < rules.window:
        return
    last = len(text) - rules.gram + 1
    for first in range(0, last, PIECE_BYTES):
        until = min(first + PIECE_BYTES, last)
        # Whether a place is an anchor depends on the grams of ``reach`` places around it.
        low, high = max(0, first - 2 * reach), min(len(text), until + 2 * reach + rules.gram)
        rolling = Rolling(np.frombuffer(text, np.uint8, high - low, low))
        hashes = rolling.grams(rules.gram)
        found = _anchors(hashes, width)
        found = found[(found >= first - low) & (found < until - low)]
        begin = np.maximum(found + low - reach, 0)
        end = np.minimum(found + low + rules.gram + reach, len(text))
        # Cut contexts have other hashes than whole ones: their lengths go in.
        context = rolling.hashes(begin - low, end - low) ^ (found + low - begin).astype(np.uint64)
        yield found + low, hashes[found], context


# A place is the offset and 31 bits of the text's hash: rows that share a doc_id stay apart,
# and places of a document are in the order of their offsets.
_MARK = 31


def _rows(docs: DataFrame) -> DataFrame:
    mark = F.xxhash64(plain_text()).bitwiseAND((1 << _MARK) - 1)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark.alias("mark"), plain_text().alias("text"))


ANCHORS = "gram long, context long, doc_id long, place long"


def _find_anchors(rules: Repeats, narrow: bool):
    """Anchors of the texts, or (narrow) the numbers of their grams alone."""

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            held, size = [], 0
            for doc_id, mark, text in zip(*(batch.column(i) for i in range(3))):
                for at, gram, context in text_anchors(text.as_py().encode(), rules):
                    place = (at.astype(np.int64) << _MARK) | mark.as_py()
                    held.append((gram.view(np.int64), context.view(np.int64), [doc_id.as_py()] * len(at), place))
                    size += len(at)
                if size > 1 << 17:
                    yield _anchor_batch(held, narrow)
                    held, size = [], 0
            if held:
                yield _anchor_batch(held, narrow)

    return run


def _anchor_batch(held: list[tuple], narrow: bool) -> pa.RecordBatch:
    gram = np.concatenate([h[0] for h in held])
    if narrow:
        distinct, n = np.unique(gram, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(n)], ["gram", "n"])
    context, place = (np.concatenate([h[i] for h in held]) for i in (1, 3))
    doc_id = pa.array([d for h in held for d in h[2]], pa.int64())
    columns = [pa.array(gram), pa.array(context), doc_id, pa.array(place)]
    return pa.RecordBatch.from_arrays(columns, ["gram", "context", "doc_id", "place"])


_LATER = "NOT (struct(doc_id, place) <=> first)"


def _first() -> Column:
    return F.min(F.struct("doc_id", "place")).alias("first")


def _repeated_anchors(rows: DataFrame, rules: Repeats, scratch: Scratch) -> DataFrame:
    """Anchors whose gram another anchor has as well."""
    grams = rows.mapInArrow(_find_anchors(rules, True), "gram long, n long")
    repeated = scratch.write(
        grams.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram"), "grams"
    )
    anchors = rows.mapInArrow(_find_anchors(rules, False), ANCHORS)
    return scratch.write(anchors.join(repeated, "gram", "left_semi"), "anchors")


# Refinement -------------------------------------------------------------------------------


def _cut_contexts(rules: Repeats):
    """Contexts as bytes, from the texts and the places of their anchors."""

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            texts, doc_ids, places, grams = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                data, at = texts[i].as_py().encode(), np.asarray(places[i].values) >> _MARK
                begin = np.maximum(at - rules.reach, 0)
                end = np.minimum(at + rules.window, len(data))
                cut = [data[b:e] for b, e in zip(begin.tolist(), end.tolist())]
                doc_id = pa.array([doc_ids[i].as_py()] * len(at), pa.int64())
                columns = [grams[i].values, doc_id, places[i].values, pa.array(cut, pa.binary()), pa.array(at - begin)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "doc_id", "place", "bytes", "left"])

    return run


CONTEXTS = "bucket long, doc_id long, place long, bytes binary, left long"
HITS = "doc_id long, place long, before long, after long"


def _sorted_on(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New bucket pointers: suffixes in the order of (own pointer, pointer of a later offset).

    The pointer of a bucket is the number of its first member in that order; members keep
    the order they came in.
    """
    keys = first * (int(second.max(initial=0)) + 1) + second
    order = np.argsort(keys, kind="stable")
    new = np.diff(keys[order], prepend=-1) != 0
    heads = np.flatnonzero(new)
    pointers = np.empty(len(keys), np.int64)
    pointers[order] = np.repeat(heads, np.diff(heads, append=len(keys)))
    return pointers, order


def refine(buckets, contexts: list[bytes], left, low, high, rules: Repeats):
    """(rows, first, last): anchors with windows that an earlier one of their bucket has too.

    Rows come in the order of (bucket, place). A window of row i starts ``low[i]`` to
    ``high[i]`` bytes before the anchor; ``first`` and ``last`` are the smallest and the
    largest such offset that is repeated.
    """
    window, reach, rows = rules.window, rules.reach, len(contexts)
    table = np.zeros((rows, reach + window), np.uint8)
    right = np.array([len(c) for c in contexts]) - left
    for i, c in enumerate(contexts):
        table[i, reach - left[i] : reach + right[i]] = np.frombuffer(c, np.uint8)
    # Suffixes are (row, offset) where the text holds the whole window.
    offsets = np.arange(reach + 1)
    within = (offsets >= low[:, None]) & (offsets <= np.minimum(high, left)[:, None])
    row, offset = np.nonzero(within & (window - offsets <= right[:, None]))
    count, begin = len(row), reach - offset
    # Initial buckets: a quarter of the window, at the four offsets that make it up.
    short = -(-window // 4)
    rest = window - 2 * short
    grams = row_hashes(table, short)
    starts = np.concatenate([begin, begin + rest])
    twice = np.concatenate([row, row])
    if grams.size < 4 * count:
        # Suffixes of a row share most of their grams: each is named once.
        _, names = np.unique(grams, return_inverse=True)
        grams = names.reshape(grams.shape)
    names = np.concatenate([grams[twice, starts], grams[twice, starts + short]])
    if names.dtype == np.uint64:
        _, names = np.unique(names, return_inverse=True)
    # Of every suffix, and of those that start where its second half does: half a window.
    half, _ = _sorted_on(names[: 2 * count].astype(np.int64), names[2 * count :])
    # Only windows at one offset of one bucket are compared: others do not keep the order.
    _, bucket = np.unique(buckets, return_inverse=True)
    own, _ = _sorted_on(bucket[row] * (reach + 1) + offset, half[:count])
    alive = np.flatnonzero(np.bincount(own, minlength=count)[own] > 1)
    # The refined pointers of later offsets sort what is left: the whole window.
    own, order = _sorted_on(own[alive], half[count:][alive])
    number = np.empty_like(order)
    number[order] = np.arange(len(order))
    hit = alive[number != own]  # all but the first of each bucket
    found, at = np.unique(row[hit], return_inverse=True)
    first, last = np.full(len(found), reach), np.zeros(len(found), np.int64)
    np.minimum.at(first, at, offset[hit])
    np.maximum.at(last, at, offset[hit])
    return found, first, last


BATCH_ROWS = 4096


def _refine_buckets(rules: Repeats):
    """Rows in order of (bucket, doc_id, place), a few whole buckets at a time."""

    def hits(rows: pa.Table) -> pa.RecordBatch:
        number = {c: np.asarray(rows.column(c)) for c in ("bucket", "place", "left", "low", "high")}
        found, first, last = refine(
            number["bucket"], rows.column("bytes").to_pylist(), number["left"], number["low"], number["high"], rules
        )
        doc_id = rows.column("doc_id").combine_chunks().take(pa.array(found))
        columns = [doc_id, pa.array(number["place"][found]), pa.array(last), pa.array(rules.window - first)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "place", "before", "after"])

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches_:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if len(held) < BATCH_ROWS:
                continue
            bucket = np.asarray(held.column("bucket"))
            whole = int(np.searchsorted(bucket, bucket[-1]))
            if whole:
                yield hits(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and len(held):
            yield hits(held)

    return run


def _halves(rules: Repeats) -> Column:
    """The two halves of a row's range of windows, each named by the bytes all its windows share."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("long")

    def half(low: Column, high: Column) -> Column:
        shared = F.substring(F.col("bytes"), (F.col("left") - low + 1).cast("int"), (rules.window - high + low).cast("int"))
        inside = (low <= F.col("left")) & (rules.window - high <= F.octet_length("bytes") - F.col("left"))
        name = F.xxhash64("bucket", low, high, shared)
        return F.when(inside, F.struct(name.alias("bucket"), low.alias("low"), high.alias("high")))

    return F.array_compact(F.array(half(F.col("low"), middle), half(middle + 1, F.col("high"))))


def _refined_hits(contexts: DataFrame, rules: Repeats, scratch: Scratch) -> DataFrame:
    """Hits among first anchors of different contexts; large buckets split until they fit."""
    rows = contexts.withColumns({"low": F.lit(0).cast("long"), "high": F.lit(rules.reach).cast("long")})
    columns, hits, level = rows.columns, [], 0
    while True:
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"), _first()).where("n > 1")
        level += 1
        sized = scratch.write(rows.join(sizes, "bucket"), f"level{level}")
        fits = F.col("n") <= rules.bucket_anchors
        light = sized.where(fits).select(columns).dropDuplicates(["bucket", "doc_id", "place"])
        ordered = light.repartition("bucket").sortWithinPartitions("bucket", "doc_id", "place")
        hits.append(ordered.mapInArrow(_refine_buckets(rules), HITS))
        heavy = sized.where(~fits)
        if heavy.isEmpty():
            return scratch.write(reduce(DataFrame.unionByName, hits), "refined")
        # A range of one window: its bucket is that window, and later members repeat it.
        single = heavy.where(F.col("low") == F.col("high")).where(_LATER)
        after = (rules.window - F.col("low")).alias("after")
        hits.append(single.select("doc_id", "place", F.col("low").alias("before"), after))
        split = heavy.where("low < high").withColumn("halves", _halves(rules))
        rest = [c for c in columns if c not in ("bucket", "low", "high")]
        rows = split.select(*rest, F.inline("halves")).select(columns)


# Texts ------------------------------------------------------------------------------------


def _by_document(found: DataFrame, *columns: str) -> DataFrame:
    """Lists by document and text: no longer than the text has anchors."""
    mark = F.col("place").bitwiseAND((1 << _MARK) - 1)
    lists = [F.collect_list(c).alias(f"{c}s") for c in columns]
    return found.groupBy(F.col("doc_id").alias("of_id"), mark.alias("of_mark")).agg(*lists)


_SAME_ROW = "doc_id <=> of_id AND mark = of_mark"
CUT = "doc_id long, n_bytes long, kept binary, spans array<struct<start: long, end: long>>"


def merged(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching stretches."""
    if not len(begin):
        return []
    order = np.argsort(begin, kind="stable")
    begin, reached = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate([[True], begin[1:] > reached[:-1]]))
    return list(zip(begin[new].tolist(), reached[np.append(new[1:], len(begin)) - 1].tolist()))


def _cut_texts(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "kept", "spans"])

    for batch in batches_:
        rows, size = [], 0
        for doc_id, text, *lists in zip(*batch.columns):
            data, spans = text.as_py().encode(), []
            if lists[0].is_valid:
                place, before, after = (np.asarray(x.values) for x in lists)
                at = place >> _MARK
                spans = merged(np.maximum(at - before, 0), np.minimum(at + after, len(data)))
            kept, reached = [], 0
            for start, end in spans:
                kept.append(data[reached:start])
                reached = end
            kept.append(data[reached:])
            told = [{"start": b, "end": e} for b, e in spans]
            rows.append((doc_id.as_py(), len(data), b"".join(kept), told))
            size += len(data)
            if size > PIECE_BYTES * 4:
                yield batch_of(rows)
                rows, size = [], 0
        if rows:
            yield batch_of(rows)


def delete_repeats(docs: DataFrame, rules: Repeats = Repeats()) -> DataFrame:
    """Texts without the bytes of windows that start earlier as well.

    doc_id, n_bytes, kept (the bytes left, which need not be whole characters), spans (start
    and end of each maximal deleted run). Earlier is a smaller doc_id, or a smaller offset in
    the same document; what is deleted does not count less as a model for others. Rows that
    share a doc_id are one document in this: of equal offsets, one text (by a hash) is the
    earlier. Rows alike in doc_id and text are judged alike, not against each other. A null
    doc_id is smaller than all others.

    Null and empty texts, and texts shorter than a window, stay as they are (null: empty).
    Very long texts are hashed in pieces. Further columns are ignored; an empty table gives
    an empty result. Equal 64-bit hashes are taken for equal grams; a context counts as
    equal by two such hashes, a window by its quarters.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    rows = _rows(docs)
    anchors = _repeated_anchors(rows, rules, scratch)
    entry = ["gram", "context"]
    firsts = scratch.write(anchors.groupBy(*entry).agg(_first(), F.count("*").alias("n")), "firsts")
    copies = anchors.join(firsts.where("n > 1").drop("n"), entry).where(_LATER).select(
        "doc_id", "place", F.lit(rules.reach).cast("long").alias("before"), F.lit(rules.window).cast("long").alias("after")
    )
    several = firsts.groupBy("gram").agg(F.count("*").alias("contexts")).where("contexts > 1").select("gram")
    open_ = firsts.join(several, "gram").select("gram", "first.doc_id", "first.place")
    wanted = _by_document(open_, "place", "gram")
    contexts = (
        rows.join(wanted, F.expr(_SAME_ROW)).select("text", "doc_id", "places", "grams")
        .mapInArrow(_cut_contexts(rules), CONTEXTS)
    )
    refined = _refined_hits(scratch.write(contexts, "contexts"), rules, scratch)
    hits = _by_document(copies.unionByName(refined), "place", "before", "after")
    return (
        rows.join(hits, F.expr(_SAME_ROW), "left").select("doc_id", "text", "places", "befores", "afters")
        .mapInArrow(_cut_texts, CUT)
    )


def digest(cut: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the bytes left."""
    return cut.select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
