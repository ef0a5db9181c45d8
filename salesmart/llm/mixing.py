"""Mixing sources to target weights by temperature (operator 3).

A source with token share p gets a weight proportional to p ** tau. The exponent is found
by bisection, so that the weights have a wanted entropy, or so that no source is repeated
more than a limit. The weights are then realised by whole passes over a source and a part
of one: a source is cut into blocks by hash, every pass takes the blocks in another order,
and the last pass ends where the source's token budget does.

Everything about a source is a row of a table. A source of n documents has about sqrt(n)
blocks, so neither a list of blocks nor a block grows beyond that, and a source with a
third of all rows is as many tasks' work as its blocks.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.llm.shared import Scratch, plain_text

STEPS = 32  # exponents tried in one pass of the bisection
PASSES = 6  # each narrows the interval 32-fold: to 1e-9
LARGEST_EXPONENT = 8.0


@dataclass(frozen=True)
class Target:
    """What the weights should meet, and how much to take.

    Exactly one of ``entropy`` (in nats) and ``repetitions`` (most passes over a source).
    ``budget`` is in tokens; without one it is the least at which every source is read
    once whole, so that no document is left out.
    """

    entropy: float | None = None
    repetitions: float | None = None
    budget: int | None = None
    seed: int = 0

    def __post_init__(self):
        if (self.entropy is None) == (self.repetitions is None):
            raise ValueError("give either an entropy or a limit of repetitions")


def token_count(text: str = "text") -> Column:
    """Words of a text and one for its end, so that no document is empty."""
    return (F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"\S+")) + 1).cast("long")


def _measures(sources: DataFrame, exponents: list[float], budget: int | None) -> list:
    """Entropy and most passes over a source at each exponent, in one aggregation."""
    tau = F.col("tau")
    z = sources.select(
        F.explode(F.array(*[F.lit(e) for e in exponents])).alias("tau"), F.log("share").alias("l")
    ).groupBy("tau").agg(
        F.sum(F.exp(tau * F.col("l"))).alias("z"),
        F.sum(F.exp(tau * F.col("l")) * F.col("l")).alias("zl"),
        F.max(F.exp((tau - 1) * F.col("l"))).alias("most"),
        F.min(F.exp((tau - 1) * F.col("l"))).alias("least"),
    )
    per_pass = F.col("least") if budget is None else F.col("z") * F.col("total") / F.lit(float(budget))
    total = sources.agg(F.sum("tokens").cast("double").alias("total"))
    return (
        z.crossJoin(total)  # one row
        .select(
            "tau", (F.log("z") - tau * F.col("zl") / F.col("z")).alias("entropy"),
            (F.col("most") / per_pass).alias("repetitions"),
        )
        .orderBy("tau").collect()  # STEPS rows
    )


def find_exponent(sources: DataFrame, target: Target) -> float:
    """The exponent at which the target is met, or the nearest the sources allow.

    Both measures fall as the exponent grows: entropy from that of equal weights, passes
    over the scarcest source down to its share of the budget at natural weights.
    """
    low, high = 0.0, LARGEST_EXPONENT if target.entropy is not None else 1.0
    name = "entropy" if target.entropy is not None else "repetitions"
    wanted = target.entropy if target.entropy is not None else target.repetitions
    for _ in range(PASSES):
        tried = [low + (high - low) * i / STEPS for i in range(STEPS + 1)]
        over = [r["tau"] for r in _measures(sources, tried, target.budget) if r[name] > wanted + 1e-12]
        if not over:
            return low
        low = max(over)
        high = min([t for t in tried if t > low], default=low)
        if high == low:
            return high
    return high


def source_table(docs: DataFrame) -> DataFrame:
    """source, documents, tokens and share of all tokens; a null source is one like others."""
    sums = docs.groupBy("source").agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"))
    total = sums.agg(F.sum("tokens").cast("double").alias("total"))
    return sums.crossJoin(total).select(  # one row
        "source", "documents", "tokens", (F.col("tokens") / F.col("total")).alias("share")
    )


def plan_sources(sources: DataFrame, exponent: float, target: Target) -> DataFrame:
    """Weights, token quotas and numbers of passes of the sources."""
    power = F.exp(F.lit(exponent) * F.log("share"))
    z = sources.agg(
        F.sum(power).alias("z"), F.sum("tokens").cast("double").alias("total"),
        F.max(F.exp((1 - F.lit(exponent)) * F.log("share"))).alias("scarce"),
    )
    weighted = sources.crossJoin(z).withColumn("weight", power / F.col("z"))  # one row
    if target.budget is None:
        # Tokens at which the source with the lowest rate is read once.
        budget = F.col("total") * F.col("scarce") * F.col("z")
    else:
        budget = F.lit(float(target.budget))
    return weighted.select(
        "source", "documents", "tokens", "share", "weight",
        F.round(budget * F.col("weight")).cast("long").alias("quota"),
        F.ceil(F.sqrt(F.col("documents").cast("double"))).cast("long").alias("blocks"),
    ).withColumn("passes", F.greatest(F.ceil(F.col("quota") / F.col("tokens")), F.lit(1)).cast("long"))


def mix(docs: DataFrame, target: Target) -> DataFrame:
    """Copies of the documents in the wanted weights: one row per document and pass.

    Adds ``tokens`` (words, plus one for the end of the document), ``weight`` of the
    source, ``pass_number`` (from 0) and ``slot`` in [0, 1): ordered by slot, any stretch
    of the result has about the target weights. A pass that is not the last is whole; in
    the last, documents are taken in block order while the quota lasts. Null sources form
    one source; null ids, null texts and repeated rows are documents like others. Columns
    with the names of added ones are replaced; names that start with ``_mix`` are
    reserved. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    docs = docs.drop("tokens", "weight", "pass_number", "slot")
    seed = F.lit(target.seed)
    marked = docs.withColumns({
        "_mix_tokens": token_count(),
        "_mix_mark": F.xxhash64(seed, F.col("doc_id"), plain_text()),
    })
    narrow = scratch.write(
        marked.select("source", F.col("_mix_tokens").alias("tokens"), "_mix_mark"), "narrow"
    )
    sources = scratch.write(source_table(narrow), "sources")
    plan = plan_sources(sources, find_exponent(sources, target), target)
    plan = scratch.write(
        plan.select(*[F.col(c).alias(f"_mix_{c}") for c in plan.columns]), "plan"
    )
    per_block = ["_mix_source", "_mix_block"]

    def in_blocks(rows: DataFrame, *columns: str) -> DataFrame:
        """Rows with their source's columns of the plan, and their block."""
        return rows.join(
            plan.select("_mix_source", "_mix_blocks", *columns),
            F.col("source").eqNullSafe(F.col("_mix_source")),
        ).withColumn("_mix_block", F.pmod("_mix_mark", "_mix_blocks"))

    quota = ["_mix_quota", "_mix_passes", "_mix_weight"]
    blocks = in_blocks(narrow, "_mix_tokens", *quota).groupBy(*per_block, "_mix_tokens", *quota).agg(
        F.sum("tokens").alias("block_tokens")
    )
    passes = blocks.withColumn(
        "pass_number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_mix_passes") - 1))
    )
    order = Window.partitionBy("_mix_source", "pass_number").orderBy(
        F.xxhash64(seed, "pass_number", "_mix_block"), "_mix_block"
    )
    earlier = F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))
    passes = scratch.write(
        passes.withColumn(
            "before", F.col("pass_number") * F.col("_mix_tokens") + F.coalesce(earlier, F.lit(0))
        ).where("before < _mix_quota"),
        "passes",
    )
    # The block in which a quota ends is taken in the order of a hash, up to ``over``.
    ends = passes.where("before + block_tokens > _mix_quota").select(
        F.col("_mix_source").alias("end_source"), F.col("_mix_block").alias("end_block"),
        "pass_number", "before", "_mix_quota",
    )
    here = F.col("_mix_source").eqNullSafe(F.col("end_source")) & (
        F.col("_mix_block") == F.col("end_block")
    )
    place = F.struct(
        F.xxhash64("pass_number", "_mix_mark").alias("hash"), F.col("_mix_mark").alias("mark")
    )
    reach = F.col("before") + F.sum("tokens").over(
        Window.partitionBy("end_source", "end_block").orderBy(place)
    )
    over = (
        in_blocks(narrow).join(ends, here).withColumn("place", place).withColumn("reach", reach)
        .where("reach > _mix_quota").groupBy("end_source", "end_block", "pass_number")
        .agg(F.min("place").alias("over"))
    )
    passes = passes.join(over.withColumnRenamed("pass_number", "end_pass"), here & (
        F.col("pass_number") == F.col("end_pass")
    ), "left")
    chosen = passes.groupBy(*per_block).agg(F.collect_list(F.struct(
        "pass_number", "before", "block_tokens", "over", F.col("_mix_quota").alias("quota"),
        F.col("_mix_weight").alias("weight"),
    )).alias("_mix_taken")).withColumnsRenamed(
        {"_mix_source": "_mix_of", "_mix_block": "_mix_in"}
    )
    taken = in_blocks(marked.withColumn("tokens", F.col("_mix_tokens")).drop("_mix_tokens")).join(
        chosen.hint("merge"),  # grows with the documents: not for broadcasting
        F.col("_mix_source").eqNullSafe(F.col("_mix_of")) & (F.col("_mix_block") == F.col("_mix_in")),
    ).withColumn("_mix_take", F.explode("_mix_taken"))
    pass_number = F.col("_mix_take.pass_number")
    place = F.struct(
        F.xxhash64(pass_number, "_mix_mark").alias("hash"), F.col("_mix_mark").alias("mark")
    )
    # The hash as a number from 0 to 1, in its own order.
    fraction = place["hash"].cast("double") / F.lit(2.0**64) + 0.5
    slot = (F.col("_mix_take.before") + fraction * F.col("_mix_take.block_tokens")) / F.col(
        "_mix_take.quota"
    )
    slot = F.least(slot, F.lit(1 - 2.0**-40))
    kept = taken.where(F.col("_mix_take.over").isNull() | (place < F.col("_mix_take.over")))
    return kept.select(
        *docs.columns, "tokens", F.col("_mix_take.weight").alias("weight"),
        pass_number.alias("pass_number"), slot.alias("slot"),
    )
