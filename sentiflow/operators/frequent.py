"""Most frequent words by sketch and verification.

Counting all words to keep a few shuffles the whole vocabulary. Here a frequent-items sketch is kept
per task instead. Sketches of bounded size merge to one per group, which names candidates; only these
are counted exactly. What a sketch leaves out has a known largest frequency, so the exact counts tell
whether the candidates hold all of the first ``n`` words. A group where they may not is counted in
full: the result is always that of exact counting.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.fixed_values import ENGLISH_STOPWORDS, FEATURE_WIDTH, TOP_WORDS
from ..functions.text import tokens, with_computed
from ..sources.storage import stage
from .summary import domain_words, token_rows

#: Items a sketch keeps track of, candidates for each wanted word, and sketches a group is merged from.
TRACKED = 10_000
SPARE = 4
PARTS = 64


def largest_miss(rows: Column, tracked: int) -> Column:
    """How often an item that a sketch over ``rows`` items does not name occurs at most.

    The sketch's map has the next power of two of ``tracked`` over its load of 3/4; its error is 3.5
    over that, as a share of all items. An item of less than twice the error may be left out.
    """
    slots = 2 ** ceil(log2(ceil(tracked / 0.75)))
    return rows * (2 * 3.5 / slots)


def frequent_words(words: DataFrame, n: int, by: str = "label", tracked: int = TRACKED) -> DataFrame:
    """``by``, ``rank``, ``word`` and ``count``: the ``n`` most frequent words of each group of
    ``words`` (``by``, ``word``), ties by word.

    There are few groups, as sketches are kept for each; a group may hold all rows. Null words do not
    count, and a null group is a group. ``tracked`` bounds a sketch, and what it takes to merge them.
    """
    rows = words.select(F.col(by).alias("group"), "word").filter("word is not null")
    wanted = SPARE * n
    if tracked < wanted + 1:
        raise ValueError(f"track more than {wanted} items to find {n}")
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("part")
    sketches = rows.groupBy("group", part).agg(
        F.expr(f"approx_top_k_accumulate(word, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("rows")
    )
    merged = sketches.groupBy("group").agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("rows").alias("rows"))
    merged = stage(merged, "word-sketches")
    named = merged.select("group", "rows", F.expr(f"inline_outer(approx_top_k_estimate(sketch, {wanted + 1}))"))
    place = F.row_number().over(W.partitionBy("group").orderBy(F.desc("count"), "item"))
    named = stage(named.withColumn("place", place), "word-candidates")
    candidates = named.filter((F.col("place") <= wanted) & F.col("item").isNotNull())
    left_out = named.groupBy("group").agg(
        F.greatest(largest_miss(F.first("rows"), tracked), F.coalesce(F.max(F.when(F.col("place") > wanted, F.col("count"))), F.lit(0))).alias("miss")
    )

    # A bounded number of words for each group.
    known = F.broadcast(candidates.select(F.col("group").alias("g"), F.col("item").alias("w")))
    counted = rows.join(known, F.col("group").eqNullSafe(F.col("g")) & (F.col("word") == F.col("w")), "left_semi")
    ranked = stage(_ranked(counted, n), "frequent-words")
    # The n-th word's count; a group of fewer candidates has no n-th word to rely on.
    last = ranked.groupBy("group").agg(F.max(F.when(F.col("rank") == n, F.col("count"))).alias("last"))
    sure = left_out.join(F.broadcast(last.withColumnRenamed("group", "g")), F.col("group").eqNullSafe(F.col("g")), "left")
    open_ = stage(sure.filter(~F.coalesce(F.col("last") > F.col("miss"), F.lit(False))).select(F.col("group").alias("g")), "open-groups")
    same = F.col("group").eqNullSafe(F.col("g"))
    found = ranked
    if not open_.isEmpty():
        full = _ranked(rows.join(F.broadcast(open_), same, "left_semi"), n)
        found = ranked.join(F.broadcast(open_), same, "left_anti").unionByName(full)
    return found.select(F.col("group").alias(by), "rank", "word", "count")


def _ranked(rows: DataFrame, n: int) -> DataFrame:
    counts = rows.groupBy("group", "word").agg(F.count(F.lit(1)).alias("count"))
    by_count = W.partitionBy("group").orderBy(F.desc("count"), "word")
    return counts.withColumn("rank", F.row_number().over(by_count)).filter(F.col("rank") <= n)


def sketched_top_words(
    df: DataFrame, n: int = TOP_WORDS, text: str = "clean_text", stop_sets: tuple[str, ...] = (), tracked: int = TRACKED
) -> DataFrame:
    """The rows of ``top_words``, without a shuffle of the vocabulary."""
    words = token_rows(df, text).withColumnRenamed("form", "word")
    if stop_sets:
        words = words.filter(~F.col("word").isin(*domain_words(stop_sets)))
    return frequent_words(words, n, tracked=tracked)


def sketched_vocabulary(
    df: DataFrame, size: int = FEATURE_WIDTH, text: str = "clean_text", min_chars: int = 2, tracked: int = 1_000_000
) -> DataFrame:
    """``word``, ``occurrences`` and ``documents`` of the ``size`` most frequent words, ties by word:
    those of ``TermStatistics.vocabulary``, without counting all words."""
    kept = (F.length("word") >= min_chars) & ~F.col("word").isin(*ENGLISH_STOPWORDS)
    all_words = df.select(F.lit(0).alias("corpus"), F.explode(tokens(text)).alias("word")).filter(kept)
    top = stage(frequent_words(all_words, size, "corpus", tracked).select("word", F.col("count").alias("occurrences")), "vocabulary")
    once = with_computed(df.select(text), "_words", F.array_distinct(tokens(text))).select(F.explode("_words").alias("word"))
    documents = once.join(F.broadcast(top.select("word")), "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("documents"))
    return top.join(F.broadcast(documents), "word")
