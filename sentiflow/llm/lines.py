"""Removal of lines that spread over many sites.

Every line hash gets a HyperLogLog sketch of the sites it is on; sketches merge by aggregation, within
tasks first, so a line in a third of all documents costs one row per task. Lines whose estimate is too
near the threshold to decide by get an exact count of distinct sites. Of a line that is boilerplate,
its first occurrence in the corpus stays and all others are removed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import lookup
from ..sources.storage import stage

MIN_SITES = 8
#: 2 to this power registers: a relative standard error of 1.04 / sqrt(4096), 1.6 %.
REGISTERS_LOG2 = 12
#: Standard errors on either side of the threshold within which sites are counted exactly.
SAFE_ERRORS = 4


def _lines(docs: DataFrame) -> DataFrame:
    """A row per line that is not blank: its document's key, site, place and hash."""
    line = F.posexplode(F.split("text", "\n")).alias("place", "line")
    rows = docs.select("key", "doc_id", "source", line)
    return rows.filter(F.trim("line") != "").select(
        "key", "doc_id", "source", "place", F.xxhash64(F.trim("line")).alias("line")
    )


def text_hash(text: Column) -> Column:
    """60 bits of a digest of a text, as a number; it decides among texts that share a ``doc_id``."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _occurrence() -> Column:
    """Order of a line's occurrences. Different texts under one ``doc_id``, or without, are told apart."""
    return F.struct("doc_id", F.col("key.text").alias("text"), "place")


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, log2_k: int = REGISTERS_LOG2) -> DataFrame:
    """``line`` and ``first`` (smallest ``doc_id``, text hash and place) of lines on at least ``min_sites`` sites."""
    margin = max(1.0, SAFE_ERRORS * 1.04 / math.sqrt(2**log2_k) * min_sites)
    sketched = lines.groupBy("line").agg(
        F.hll_sketch_agg("source", F.lit(log2_k)).alias("sketch"), F.min(_occurrence()).alias("first")
    )
    estimated = sketched.select("line", "first", F.hll_sketch_estimate("sketch").alias("sites"))
    likely = stage(estimated.filter(F.col("sites") >= min_sites - margin), "line-estimates")
    near = likely.filter(F.col("sites") < min_sites + margin)
    exact = (
        lookup(lines.select("line", "source"), near.select("line"), "line")
        .groupBy("line")
        .agg(F.count_distinct("source").alias("sites"))
        .filter(F.col("sites") >= min_sites)
    )
    certain = likely.filter(F.col("sites") >= min_sites + margin).select("line", "first")
    return stage(certain.unionByName(near.join(exact.select("line"), "line", "left_semi").select("line", "first")), "line-spread")


def without_spread_lines(docs: DataFrame, min_sites: int = MIN_SITES, log2_k: int = REGISTERS_LOG2) -> DataFrame:
    """Each row of ``docs`` (``doc_id``, ``source``, ``text``) as ``row``, a struct of all its columns,
    with ``text`` without boilerplate, ``n_lines`` and ``n_removed``.

    Lines are compared without the spaces around them; blank ones are never removed. Null sources are
    no site. Null texts stay null and have no lines. The first occurrence goes by ``doc_id`` (null
    first), then by a hash of the text, then by place; only rows equal in both ``doc_id`` and text
    that hold it all keep it. Other columns stay in ``row``, whatever their names.
    """
    text = F.col("text").cast("string")
    key = F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), text_hash(text).alias("text"))
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"), "doc_id", F.col("source").cast("string"), text.alias("text"))
    lines = _lines(rows)
    spread = spread_lines(lines, min_sites, log2_k)
    removed = (
        lookup(lines, spread, "line")
        .filter(~_occurrence().eqNullSafe(F.col("first")))
        .groupBy("key")
        .agg(F.collect_set("place").alias("removed"))
    )
    removed = stage(removed, "line-removals")
    split = F.split("text", "\n")
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("removed"))
    kept = F.array_join(F.transform(places, lambda i: F.get("lines", i)), "\n")
    return (
        lookup(rows.select("row", "key", "text"), removed, "key", "left")
        .withColumn("lines", F.when(F.col("removed").isNotNull(), split))
        .select(
            "row",
            F.when(F.col("removed").isNull(), F.col("text")).otherwise(kept).alias("text"),
            F.coalesce(F.size(split), F.lit(0)).alias("n_lines"),
            F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
        )
        .withColumn("n_lines", F.greatest("n_lines", F.lit(0)).cast("bigint"))
        .withColumn("n_removed", F.greatest("n_removed", F.lit(0)).cast("bigint"))
    )


def deduplicated(docs: DataFrame, min_sites: int = MIN_SITES, log2_k: int = REGISTERS_LOG2) -> DataFrame:
    """``docs`` with their columns, ``text`` (and ``n_chars``, where there is one) without boilerplate."""
    cleaned = without_spread_lines(docs, min_sites, log2_k)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return cleaned.select(*(new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns))
