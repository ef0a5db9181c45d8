"""Incremental refresh: a stream of changed rows merged into a table."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from salesmart.operators.landing import latest_changes, merge_ordered
from salesmart.sources.tables import merge_ranged, rows_of_keys
from salesmart.sources.versions import (
    range_settings, read_versioned, replace_keys, rows_of_ranges, touched_ranges,
)


def _available_now(
    changes: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        changes.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_merge(
    changes: DataFrame,
    table: str,
    keys: Sequence[str],
    newest_by: str,
    checkpoint: str,
) -> StreamingQuery:
    """Merge everything a streaming frame holds now into a table of ``create_ranged``.

    Each batch keeps the newest row per key, the stored one included, and rewrites the key
    ranges it touches: a change that comes late does not undo a newer one. A batch that is
    run again after a failure leaves the same table, so the checkpoint makes the merge
    exactly-once. The query ends when the available changes are used up; start it again,
    with the same checkpoint, for the next ones. A session that has read the table before
    must refresh it to see the merge. For changes that delete rows, see ``stream_ordered``.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        # Read more than once: for the ranges it touches and for its rows.
        newest = latest_changes(batch, keys, newest_by).persist()
        try:
            stored = rows_of_keys(newest, table, keys).select(*newest.columns)
            merge_ranged(latest_changes(newest.unionByName(stored), keys, newest_by), table, keys)
        finally:
            newest.unpersist()

    return _available_now(changes, merge, checkpoint)


def stream_ordered(
    changes: DataFrame,
    table: str,
    keys: Sequence[str],
    newest_by: str,
    checkpoint: str,
    deleted: str = "is_deleted",
) -> StreamingQuery:
    """Merge changes and deletions into a table of ``versions.refresh_versioned``.

    A deletion is a row with ``deleted`` true. It is kept in the table as a mark, and every
    row is compared with the stored one of its key (``landing.merge_ordered``), so the table
    is the same however the changes are split into batches and in whatever order they come.
    ``landing.live_rows`` leaves the marks out. The table's range key must be one of
    ``keys``. Each batch is one switch of the table and may be run again.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        range_key, _ = range_settings(spark, table)
        if range_key not in keys:
            raise ValueError(f"the range key {range_key} must be one of the keys")
        newest = merge_ordered(batch.limit(0), batch, keys, newest_by, deleted).persist()
        try:
            ids = newest.select(range_key).distinct()
            if not ids.isEmpty():
                columns = read_versioned(spark, table).columns
                near = rows_of_ranges(spark, table, touched_ranges(spark, table, ids))
                stored = near.join(ids, range_key, "left_semi").select(*columns)
                merged = merge_ordered(stored, newest.select(*columns), keys, newest_by, deleted)
                replace_keys(merged, table, ids)
        finally:
            newest.unpersist()

    return _available_now(changes, merge, checkpoint)
