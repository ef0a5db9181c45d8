"""Session settings the warehouse relies on.

Partition counts and join strategies are re-planned at run time by adaptive execution. A
session made elsewhere works as well, as long as adaptive execution is left on.
"""

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates and timestamps carry no zone; a fixed zone keeps conversions reproducible.
    "spark.sql.session.timeZone": "UTC",
    # Overflow and division by zero fail the job instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key is split over several tasks on the order side of a join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

MIN_PARTITIONS = 200
PARTITION_BYTES = 512 * 1024 * 1024


def shuffle_partitions(largest_shuffle_bytes: int) -> int:
    """Partitions for the largest shuffle of a run, so that each fits a task's memory.

    Adaptive execution merges partitions that turn out small but never makes more of
    them, so the count has to suit the largest: some 20,000 for one of 10 TB.
    """
    return max(MIN_PARTITIONS, -(-largest_shuffle_bytes // PARTITION_BYTES))


def build_session(
    app: str = "salesmart",
    master: str | None = None,
    largest_shuffle_bytes: int = 0,
    **extra: str,
) -> SparkSession:
    """A session with ``SETTINGS``; ``extra`` entries are further Spark settings.

    ``largest_shuffle_bytes`` is about the size of the order columns a fact build reads.
    """
    partitions = {"spark.sql.shuffle.partitions": str(shuffle_partitions(largest_shuffle_bytes))}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **partitions, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
