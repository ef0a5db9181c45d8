"""Nearest neighbours by multiprobe p-stable hashing (operator 2).

A hash is the number of the cell of width ``width`` in which a vector's projection on a
Gaussian direction falls; ``hashes`` of them name a bucket of a table. A query visits its
own bucket and those next to it, in the order of the estimated chance of success: the
smaller the sum of squared distances to the cell borders that are crossed, the earlier.
What the tables find is merged and ranked by the exact inner product.

Inner products are made distances by one more component: vectors are scaled into the unit
ball and completed to length one, queries scaled to length one and given a zero. Vectors
whose norms lie between the same powers of two are a range and scaled by the longest of
them, so a long vector does not draw the others together. A range of few rows is met by
every query, and a query that meets fewer than ``neighbours`` rows in all its buckets is
compared with every row.

Buckets are spread over tasks. The vectors of a bucket are cut into parts of about
``part_rows``, its queries too, and each part of the one meets each part of the other.
What a task holds at a time is bounded, and a bucket with a third of all rows is as many
tasks' work as it has pairs of parts.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.llm.shared import Scratch


@dataclass(frozen=True)
class Probing:
    """Parameters of the hash tables.

    The defaults suit vectors of little contrast: on the test vectors they find 0.95 of
    the true neighbours. More hashes, with more probes, make buckets smaller.
    """

    neighbours: int = 20
    tables: int = 12
    hashes: int = 3
    probes: int = 12
    width: float = 1.0
    part_rows: int = 4096
    small_range: int = 256
    seed: int = 7

    def directions(self, table: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        draw = np.random.default_rng((self.seed, table))
        return draw.normal(size=(size, self.hashes)), draw.uniform(0, self.width, self.hashes)


def usable(vector: str) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    def bad(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))

    return (
        F.col(vector).isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(False))
        & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    )


def _cells(vectors: np.ndarray, table: int, probing: Probing) -> tuple[np.ndarray, np.ndarray]:
    """Cell numbers, and places within the cells in [0, 1)."""
    directions, shifts = probing.directions(table, vectors.shape[1])
    places = (vectors @ directions + shifts) / probing.width
    cells = np.floor(places)
    return cells.astype(np.int64), places - cells


def _bucket(cells: np.ndarray) -> np.ndarray:
    """One number for a row of cell numbers (21 bits each; more hashes wrap around)."""
    key = np.zeros(len(cells), np.int64)
    for column in cells.T:
        key = key * np.int64(2_097_143) + column
    return key


def _stacked(batch: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in batch])


def _norms(vectors: np.ndarray) -> np.ndarray:
    """Lengths, without squares of very large or very small components."""
    peak = np.abs(vectors).max(axis=1)
    with np.errstate(over="ignore"):
        lengths = peak * np.linalg.norm(vectors / peak[:, None], axis=1)
    return np.minimum(lengths, np.finfo(float).max)


EVERYONE = -1  # the table whose only bucket every query visits


def _hashed(probing: Probing, longest: dict[int, float]):
    """Rows (vec_id, embedding, range) with their bucket in every table.

    ``longest`` has the norm to scale by for each range that is not small.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            scale = batch.pop("range").map(longest)
            small = scale.isna()
            if small.any():
                yield batch[small].assign(table=np.int32(EVERYONE), bucket=np.int64(0))
            if small.all():
                continue
            batch = batch[~small]
            vectors = _stacked(batch["embedding"]) / scale[~small].to_numpy(float)[:, None]
            rest = np.sqrt(np.maximum(0, 1 - (vectors**2).sum(axis=1)))
            vectors = np.column_stack([vectors, rest])
            for table in range(probing.tables):
                cells, _ = _cells(vectors, table, probing)
                yield batch.assign(table=np.int32(table), bucket=_bucket(cells))

    return run


def _probed(probing: Probing):
    """Queries with the buckets that they visit, and the order of the visit."""
    moves = np.array(list(product((0, -1, 1), repeat=probing.hashes)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            vectors = _stacked(batch["embedding"])
            vectors /= _norms(vectors)[:, None]
            vectors = np.column_stack([vectors, np.zeros(len(vectors))])
            yield batch.assign(
                table=np.int32(EVERYONE), probe=np.int32(0), bucket=np.int64(0)
            )
            for table in range(probing.tables):
                cells, within = _cells(vectors, table, probing)
                down, up = within[:, None, :] ** 2, (1 - within[:, None, :]) ** 2
                cost = np.where(moves < 0, down, np.where(moves > 0, up, 0)).sum(axis=2)
                order = np.argsort(cost, axis=1, kind="stable")[:, : probing.probes]
                for probe in range(order.shape[1]):
                    yield batch.assign(
                        table=np.int32(table), probe=np.int32(probe),
                        bucket=_bucket(cells + moves[order[:, probe]]),
                    )

    return run


def _ranked(probing: Probing):
    """Best vectors of one part of a bucket for each query that visits it."""

    def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or vectors.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        table, ids = _stacked(vectors["embedding"]), vectors["vec_id"].to_numpy(np.int64)
        order = np.argsort(ids, kind="stable")
        table, ids, found = table[order], ids[order], []
        lengths = _norms(table)
        for first in range(0, len(queries), 1024):
            part = queries.iloc[first : first + 1024]
            asked = part["query_id"].to_numpy(np.int64)
            left = _stacked(part["embedding"])
            scores = left @ table.T
            scores[asked[:, None] == ids] = -np.inf
            take = min(probing.neighbours + 1, len(ids))
            # Ties go to smaller ids: a stable sort of vectors in the order of ids, by
            # scores without the last digits, which depend on the place in the product.
            # What the last digits are, the two lengths say: one long vector hides no others.
            coarse = np.round(scores / _norms(left)[:, None] / lengths, 12) * lengths
            best = np.argsort(-coarse, axis=1, kind="stable")[:, :take]
            rows = np.repeat(asked, take)
            exact = (np.repeat(left, take, axis=0) * table[best.ravel()]).sum(axis=1)
            out = pd.DataFrame({"query_id": rows, "vec_id": ids[best].ravel(), "score": exact})
            found.append(out[out["query_id"] != out["vec_id"]])
        return pd.concat(found)

    def quiet(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        with np.errstate(over="ignore", invalid="ignore"):  # products beyond a double
            return run(queries, vectors)

    return quiet


def nearest(vectors: DataFrame, queries: DataFrame, probing: Probing) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the vectors of largest inner product found.

    Every query gets ``neighbours`` rows, or all candidates if there are fewer. Both tables
    have vec_id and embedding. Vectors that are null, empty, zero, or hold a
    null or non-finite component take no part, and a row without a vec_id neither; all
    others must have one length. Finite components may be of any size; products that are no
    numbers (beyond a double, of both signs) come last. Ties go to the smaller vec_id; rows
    that repeat a vec_id and its vector count once. A query's own vec_id is no candidate. Further columns are
    ignored; empty tables give an empty result.
    """
    scratch = Scratch(vectors.sparkSession, "neighbours")
    # The longest component goes before the squares, which may be too large for a double.
    peak = F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))
    squares = F.aggregate(
        "embedding", F.lit(0.0), lambda s, x: s + (x.cast("double") / peak) * (x.cast("double") / peak)
    )
    length = F.least(peak * F.sqrt(squares), F.lit(1.7976931348623157e308))
    power = F.floor(F.log2(peak) + F.log2(squares) / 2).cast("int")
    kept = vectors.where(usable("embedding") & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding", power.alias("range")
    ).distinct()
    asked = queries.where(usable("embedding") & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("query_id"), "embedding"
    ).distinct()
    ranges = kept.groupBy("range").agg(F.max(length).alias("longest"), F.count("*").alias("n"))
    ranges = ranges.where(F.col("n") > probing.small_range).collect()  # a row a power of two
    longest = {r["range"]: r["longest"] or 1.0 for r in ranges}
    kind = kept.schema["embedding"].dataType.simpleString()
    hashed = scratch.write(
        kept.mapInPandas(
            _hashed(probing, longest), f"vec_id long, embedding {kind}, table int, bucket long"
        ),
        "hashed",
    )
    probed = asked.mapInPandas(
        _probed(probing),
        f"query_id long, embedding {kind}, table int, probe int, bucket long",
    )
    ranked = scratch.write(_compared(probed, hashed, probing, scratch, "met"), "ranked")
    full = ranked.where(F.col("rank") == probing.neighbours).select("query_id")
    short = scratch.write(asked.join(full, "query_id", "left_anti"), "short")
    if short.isEmpty():
        return ranked
    one = {"table": F.lit(EVERYONE), "bucket": F.lit(0).cast("long")}
    rest = _compared(
        short.withColumns(one), kept.drop("range").withColumns(one), probing, scratch, "all"
    )
    return ranked.join(full, "query_id", "left_semi").select(*ranked.columns).union(rest)


def _compared(
    probed: DataFrame, hashed: DataFrame, probing: Probing, scratch: Scratch, name: str
) -> DataFrame:
    """query_id, rank, vec_id, score: the best of what queries and vectors share buckets."""
    bucket = ["table", "bucket"]

    def parts(rows: DataFrame, column: str) -> DataFrame:
        count = F.ceil(F.col("count") / probing.part_rows).cast("int")
        return rows.groupBy(*bucket).count().select(*bucket, count.alias(column))

    sizes = scratch.write(
        parts(hashed, "parts").join(parts(probed, "query_parts"), bucket), f"parts-{name}"
    )

    def dealt(rows: DataFrame, row_id: str, own: tuple[str, str], other: tuple[str, str]):
        """Each row in its own part, with every part of the other side."""
        number = F.pmod(F.xxhash64(row_id, "embedding"), F.col(own[1])).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other[1]) - 1))
        return rows.join(sizes, bucket).withColumn(own[0], number).withColumn(
            other[0], every
        ).select(row_id, *key, "embedding")

    key = [*bucket, "part", "query_part"]
    vector, query = ("part", "parts"), ("query_part", "query_parts")
    found = (
        dealt(probed, "query_id", query, vector).groupBy(*key)
        .cogroup(dealt(hashed, "vec_id", vector, query).groupBy(*key))
        .applyInPandas(_ranked(probing), "query_id long, vec_id long, score double")
    )
    # The same pair from several tables has the same score.
    merged = found.distinct()
    # Products that overflow with both signs are no numbers, and come last.
    order = Window.partitionBy("query_id").orderBy(
        F.isnan("score"), F.col("score").desc(), "vec_id"
    )
    return merged.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= probing.neighbours
    ).select("query_id", "rank", "vec_id", "score")
