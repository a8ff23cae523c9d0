"""Mixing sources to target weights by capped water-filling.

Every source wants a share of the mix by its weight, but gives at most ``max_epochs`` times its size.
Sources above that are clamped and their excess goes to the others by weight, until none is above.
Within a source every document is taken ``floor(target / size)`` times, and a seeded part of the
documents once more, in the order of a hash until the rest of the target is reached.

What the jobs move: one row per source and bucket of the hash, and the documents of the one bucket
per source in which the target is reached. No source is ranked or gathered as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import stage
from .common import SPACED_WORD, text_or_empty

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
#: Sources up to this number are broadcast, about 100 bytes each.
BROADCAST_SOURCES = 50_000


def n_words(name: str = "text") -> Column:
    """Number of runs without white space; 0 for null."""
    return F.regexp_count(text_or_empty(name), F.lit(SPACED_WORD)).cast("bigint")


def repeating_weights(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Add ``weight`` to one row per source: ``weights`` over and over, by code point, null last.

    The ranking is over one row per source, not over documents.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = F.array(*(F.lit(float(w)) for w in weights))
    return sources.withColumn("weight", F.element_at(listed, place % len(weights) + 1))


def water_fill(sources: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to a stored table (``source``, ``source_size``, ``weight``).

    Each round is one aggregation to one row: what the clamped sources give, and the weight of the
    others, set the level of the next round. The level only rises, so rounds end at the latest when
    every source is clamped. An empty table stays empty; sources of size 0 get target 0.
    """
    cap = F.col("source_size") * float(max_epochs)
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = share * (total or 0) / weight if weight else 0.0
    while True:
        clamped = F.lit(level) * F.col("weight") >= cap
        given, open_weight = sources.agg(
            F.sum(F.when(clamped, cap).otherwise(0.0)), F.sum(F.when(clamped, 0.0).otherwise(F.col("weight")))
        ).first()
        if not open_weight:
            return sources.withColumn("target", cap if weight else F.lit(0.0))
        raised = (share * total - given) / open_weight
        if raised <= level:
            return sources.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))
        level = raised


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: str = "mix",
    hex_digits: int = 3,
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``source``, ``text``): ``row``, all its columns as a
    struct, with ``size``, ``source_size``, ``target`` and ``repeats``, how often it is taken.

    Null texts have size 0; a null source is a source of its own, the last. A row's place in the
    order is a hash of its ``doc_id`` and its text, so rows without a ``doc_id`` or under one id are
    dealt out like all others, and only rows equal in both share a place. Columns of any name may
    come along in ``row``. ``hex_digits`` sets the number of hash buckets, 16 to that power.
    """
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    place = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("source").cast("string").alias("source"),
        n_words().alias("size"),
        place.alias("place"),
        F.substring(place, 1, hex_digits).alias("bucket"),
    )
    sums = stage(rows.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "mix-buckets")
    sized = stage(sums.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    sources = stage(water_fill(stage(repeating_weights(sized, weights), "mix-sources"), share, max_epochs), "mix-targets")
    whole = F.coalesce(F.floor(F.try_divide("target", F.col("source_size").cast("double"))), F.lit(0)).cast("bigint")
    plan = sources.select(
        "source", "source_size", "target", whole.alias("whole"), (F.col("target") - whole * F.col("source_size")).alias("rest")
    )

    # The bucket of each source in which the rest of its target is reached.
    so_far = F.sum("size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    reached = (
        sums.join(plan.select(F.col("source").alias("of"), "rest"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("before", so_far - F.col("size"))
        .filter(F.col("before") + F.col("size") > F.col("rest"))
        .groupBy(F.col("source").alias("of"))
        .agg(F.min("bucket").alias("last"), F.min("before").alias("before"))
    )
    plan = stage(
        plan.join(reached, F.col("source").eqNullSafe(F.col("of")), "left").select(
            F.col("source").alias("of"),
            "source_size",
            "target",
            "whole",
            F.coalesce("last", F.lit("g")).alias("last"),  # beyond all hex digits: every document
            (F.col("rest") - F.col("before")).alias("left"),
        ),
        "mix-plan",
    )
    side = F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan
    planned = rows.join(side, F.col("source").eqNullSafe(F.col("of")), "left")
    inside = planned.filter(F.col("bucket") == F.col("last"))
    ahead = F.sum("size").over(
        Window.partitionBy("source").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, 0)
    ) - F.col("size") / 2
    taken = inside.withColumn("more", (ahead <= F.col("left")).cast("bigint"))
    others = planned.filter(F.col("bucket") != F.col("last")).withColumn(
        "more", (F.col("bucket") < F.col("last")).cast("bigint")
    )
    both = others.unionByName(taken)
    return both.select("row", "size", "source_size", "target", (F.col("whole") + F.col("more")).alias("repeats"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    mixed = mix(docs, **settings).filter(F.col("repeats") > 0)
    times = F.explode(F.array_repeat(F.lit(1), F.col("repeats").cast("int"))).alias("time")
    return mixed.select("row", times).select("row.*")
