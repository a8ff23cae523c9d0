"""License scans by diagonal voting.

Every run of ``k`` words of a text is joined with the places where it occurs in the templates. The
distance between place in the text and place in the template is the diagonal; an occurrence of a
template is a diagonal with many votes, or several neighbouring ones where words were put in or left
out. Votes are counted within each map task before they are shuffled, and what is shuffled grows with
the matches, not with the texts. Templates are fixed values, so their side of the join is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NOT_WORD, ascii_lower, text_or_empty

# The phrases that are looked for word by word, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Sentences of public license notices, and the labels they are evidence for.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files": "mit-text",
    "the software is provided as is without warranty of any kind express or implied": "mit-text",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "bsd-text",
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation": "gpl-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "released under the mit license": "mit-release",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "all rights reserved": "all-rights-reserved",
}

#: Words in a run: as many as the shortest phrase has.
K = 2
#: Diagonals at most this far from the one before belong together.
NEIGHBOURS = 3
#: Share of a notice's runs that a span must hold, in any of its diagonals.
COVERAGE = 0.75
#: Different runs of a notice that a diagonal must hold.
MIN_VOTES = 2


def templates(spark: SparkSession, k: int = K) -> DataFrame:
    """A row for each run of ``k`` words of each template: ``gram``, ``template``, ``at``, ``runs`` (of
    the template), ``label`` and ``exact``, whether every word counts."""
    rows = []
    listed = [(*x, True) for x in PHRASES.items()] + [(*x, False) for x in NOTICES.items()]
    for template, (words, label, exact) in enumerate(listed):
        words = words.split()
        n = len(words) - k + 1
        rows += [(" ".join(words[i : i + k]), template, i, n, label, exact) for i in range(n)]
    schema = "gram string, template int, at int, runs int, label string, exact boolean"
    # The row that keeps documents without a match, see scan().
    return spark.createDataFrame([*rows, ("", -1, 0, 0, None, False)], schema)


def words_of(text: Column) -> Column:
    """Words of a text, in order: digits, letters and all characters beyond ASCII; A-Z in lower case."""
    return F.filter(F.split(ascii_lower(text), NOT_WORD), lambda w: w != "")


def _span(first: str, last: str, share: str, k: int) -> Column:
    begins = F.greatest(F.col(first), F.lit(0))
    return F.struct("label", begins.alias("first"), (F.col(last) + k - 1).alias("last"), F.col(share).alias("share"))


def scan(
    docs: DataFrame,
    k: int = K,
    neighbours: int = NEIGHBOURS,
    min_votes: int = MIN_VOTES,
    coverage: float = COVERAGE,
) -> DataFrame:
    """Labels of every row of ``docs`` (``doc_id``, ``text``).

    Columns: ``doc_id``, ``n_words``, ``n_base`` (places of the phrases), ``first_word`` and
    ``last_word`` (smallest and largest start of such a place, null without any), ``base_labels``,
    ``labels`` (the phrases' and those of notices found; distinct, sorted, joined by commas, empty
    without any), ``score`` (the best share of a template found, 0 to 1) and ``spans``, the notices
    found: label, first and last word and coverage. A span is verified by the runs it holds, which
    were compared word by word: enough of its notice's, and within twice the notice's length. Where a
    notice is repeated so closely that its spans run into one that is longer, each diagonal is
    verified with those up to ``neighbours`` before it instead.

    Null texts are empty and have no words. Equal rows give equal results, each its own. Documents
    are told apart by ``doc_id`` and text; a null ``doc_id`` is one as any other. Other columns are
    ignored.
    """
    key = ["doc_id", "text_hash"]
    rows = docs.select(
        "doc_id",
        F.xxhash64(text_or_empty()).alias("text_hash"),
        words_of(text_or_empty()).alias("words"),
    ).withColumn("n_words", F.size("words").cast("bigint"))
    # Places of all runs, from 0. One more, -1, stands for the document itself: its empty run meets
    # the template of no words, so documents without a match stay.
    places = F.sequence(F.lit(-1), F.greatest(F.size("words") - k, F.lit(-1)))
    runs = rows.select(*key, "n_words", "words", F.explode(places).alias("place"))
    gram = F.when(F.col("place") < 0, "").otherwise(
        F.concat_ws(" ", *(F.get("words", F.greatest(F.col("place"), F.lit(0)) + i) for i in range(k)))
    )
    found = (
        runs.select(*key, "n_words", "place", gram.alias("gram"))
        .join(F.broadcast(templates(docs.sparkSession, k)), "gram")
        .withColumn("diagonal", F.when(F.col("template") >= 0, F.col("place") - F.col("at")))
    )
    # Votes by diagonal. Equal rows of the input vote together; the document's own row counts them.
    votes = found.groupBy(*key, "template", "diagonal", "runs", "label", "exact").agg(
        F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("votes"), F.collect_set("at").alias("hits")
    )
    # One vote for a notice is chance, as a run of two frequent words is in many texts.
    enough = F.col("exact") | (F.col("template") < 0) | (F.size("hits") >= min_votes)
    # Neighbouring diagonals of a notice are one span.
    along = Window.partitionBy(*key, "template").orderBy("diagonal")
    jump = F.coalesce(F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(along) > neighbours), F.lit(True))
    near = _span("near_first", "near_last", "near_share", k)
    close = along.rangeBetween(-neighbours, 0)
    spans = (
        votes.filter(enough)
        .withColumn("span", F.sum(jump.cast("int")).over(along))
        .withColumn("near", F.size(F.array_distinct(F.flatten(F.collect_list("hits").over(close)))))
        .withColumn("near_first", F.min("diagonal").over(close))
        .withColumn("near_last", F.max(F.col("diagonal") + F.array_max("hits")).over(close))
        .withColumn("near_share", F.coalesce(F.try_divide("near", F.col("runs")), F.lit(0.0)))
        .groupBy(*key, "template", "runs", "label", "exact", "span")
        .agg(
            F.max("n_words").alias("n_words"),
            F.max("votes").alias("votes"),
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.min("diagonal").alias("first"),
            (F.max(F.col("diagonal") + F.array_max("hits"))).alias("last"),
            F.max("near_share").alias("near_share"),
            F.collect_list(F.when(~F.col("exact") & (F.col("near_share") >= coverage), near)).alias("nears"),
        )
        .withColumn("fits", F.col("exact") | (F.col("last") - F.col("first") < 2 * F.col("runs")))
        .withColumn("share", F.coalesce(F.try_divide(F.size("hits"), F.col("runs")), F.lit(0.0)))
        .withColumn("share", F.when(F.col("fits"), F.col("share")).otherwise(F.col("near_share")))
    )
    is_base = F.col("exact") & (F.size("hits") == F.col("runs"))
    is_notice = ~F.col("exact") & (F.col("template") >= 0) & (F.col("share") >= coverage)
    known = is_base | is_notice
    joined = lambda labels: F.array_join(F.array_sort(F.collect_set(labels)), ",")
    found_spans = F.when(F.col("fits"), F.array(_span("first", "last", "share", k))).otherwise(F.col("nears"))
    results = spans.groupBy(*key).agg(
        F.max("n_words").alias("n_words"),
        F.max(F.when(F.col("template") < 0, F.col("votes"))).alias("copies"),
        F.sum(is_base.cast("bigint")).alias("n_base"),
        F.min(F.when(is_base, F.col("first"))).cast("bigint").alias("first_word"),
        F.max(F.when(is_base, F.col("first"))).cast("bigint").alias("last_word"),
        joined(F.when(is_base, F.col("label"))).alias("base_labels"),
        joined(F.when(known, F.col("label"))).alias("labels"),
        F.max(F.when(known, F.col("share")).otherwise(0.0)).alias("score"),
        F.array_sort(F.flatten(F.collect_list(F.when(is_notice, found_spans)))).alias("spans"),
    )
    once = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return results.select("*", once).drop("text_hash", "copies", "copy")
