"""Surrogate keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text standing for NULL inside a key.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str | Column, null_marker: str = NULL_MARKER) -> Column:
    """MD5 of the columns' text joined by ``-``, NULLs written as ``null_marker``."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(p.cast("string"), F.lit(null_marker)) for p in parts]
    return F.md5(texts[0] if len(texts) == 1 else F.concat_ws("-", *texts))
