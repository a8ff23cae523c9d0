"""Hashes that depend only on the row's key, so results do not change with partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column


def key_hash(key: Column | str, seed: int) -> Column:
    """md5 of ``seed:key`` as 32 hex digits."""
    return F.md5(F.concat(F.lit(f"{seed}:"), as_column(key).cast("string")))


def leading_bits(digest: Column, digits: int) -> Column:
    """The first ``digits`` hex digits of a digest as a bigint."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")
