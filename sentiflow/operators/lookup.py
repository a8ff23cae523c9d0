"""Adding the columns of a keyed table to a much larger one whose keys are skewed."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import stage

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_KEYS = 50_000


def table_bytes(df: DataFrame) -> int:
    """Upper estimate of the size of ``df`` in memory: text length plus 16 bytes per value."""
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns]
    return df.agg(F.sum(reduce(add, sizes)).alias("bytes")).first()["bytes"] or 0


def lookup(
    rows: DataFrame,
    table: DataFrame,
    on: str,
    how: str = "inner",
    counts: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Join ``table`` (one row per ``on``) to ``rows``, ``inner`` or ``left``.

    A table measured below ``broadcast_bytes`` is broadcast. Beyond that the work is split by key
    frequency. A key is hot when it holds more than one ``hot_keys``-th of all rows, so there are
    fewer than ``hot_keys`` of them and their part of the table can be broadcast whatever the data
    size. The remaining rows have no heavy key and go through an ordinary shuffled join. Both parts
    together are the whole result.

    ``counts`` (``on``, ``n``) are the key frequencies of ``rows``, where known.
    """
    if table_bytes(table) <= broadcast_bytes:
        return rows.join(F.broadcast(table), on, how)
    if counts is None:
        counts = stage(rows.groupBy(on).agg(F.count(F.lit(1)).alias("n")), "key-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(counts.filter(F.col("n") * hot_keys > total).select(on))
    hot_rows = rows.join(F.broadcast(hot.join(table, on, how)), on)
    other_rows = rows.join(hot, on, "left_anti").join(table, on, how)
    return hot_rows.unionByName(other_rows)
