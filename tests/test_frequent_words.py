"""Frequent words by sketch and verification, and term statistics that merge."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sentiflow.operators import TermStatistics, add_batch, frequent_words, sketched_top_words, sketched_vocabulary, tfidf, top_words
from sentiflow.operators import frequent
from sentiflow.sources import scratch_path


def expected(rows, n):
    counts = Counter((g, w) for g, w in rows if w is not None)
    out = set()
    for group in {g for g, _ in counts}:
        ranked = sorted((-c, w) for (g, w), c in counts.items() if g == group)[:n]
        out |= {(group, k + 1, w, -c) for k, (c, w) in enumerate(ranked)}
    return out


def zipf_rows(seed, n=30_000, vocabulary=4000):
    rng = random.Random(seed)
    skewed = [(rng.choice([0.0, 1.0, None]), f"w{int(vocabulary ** rng.random())}") for _ in range(n)]
    return skewed + [(2.0, f"u{i}") for i in range(2000)] + [(0.0, None)] * 5


@pytest.mark.parametrize("tracked", [21, 100, 2000])
def test_equal_to_counting_whatever_the_sketch_keeps(spark, tracked):
    """Group 2 has no frequent words at all: no sketch can tell, so it is counted in full."""
    rows = zipf_rows(tracked)
    table = spark.createDataFrame(rows, "label double, word string").repartition(5)
    assert set(map(tuple, frequent_words(table, 5, tracked=tracked).collect())) == expected(rows, 5)


def test_full_counts_are_for_open_groups_only(spark, monkeypatch):
    """Of a sketch that tells, only candidates are counted: the vocabulary is not shuffled."""
    counted = []
    original = frequent._ranked
    monkeypatch.setattr(frequent, "_ranked", lambda rows, n: counted.append(rows) or original(rows, n))
    skewed = [(0.0, f"w{i}") for i in range(3000)] + [(0.0, f"top{k}") for k in range(3) for _ in range(5000 + k)]
    table = spark.createDataFrame(skewed, "label double, word string")
    assert frequent_words(table, 3, tracked=2000).count() == 3
    assert len(counted) == 1 and counted[0].select("word").distinct().count() <= 3 * frequent.SPARE
    flat = spark.createDataFrame([(0.0, f"w{i}") for i in range(3000)], "label double, word string")
    assert [r.word for r in frequent_words(flat, 2, tracked=100).collect()] == ["w0", "w1"]
    assert len(counted) == 3


def test_ties_at_the_end_go_by_word(spark):
    rows = [(1.0, w) for w in "abcdefgh" for _ in range(10)]
    table = spark.createDataFrame(rows, "label double, word string")
    assert set(map(tuple, frequent_words(table, 3, tracked=50).collect())) == expected(rows, 3)


def test_empty_and_too_small_sketch(spark):
    empty = spark.createDataFrame([], "label double, word string")
    assert frequent_words(empty, 3).count() == 0
    with pytest.raises(ValueError):
        frequent_words(empty, 100, tracked=100)


def test_sketched_reports_equal_the_counted_ones(cleaned):
    assert sorted(map(tuple, sketched_top_words(cleaned, 10).collect())) == sorted(map(tuple, top_words(cleaned, 10).collect()))
    vocabulary = TermStatistics.of(cleaned, min_chars=2).vocabulary(50)
    found = sketched_vocabulary(cleaned, 50)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, vocabulary.select(found.columns).collect()))


def test_batches_merge_to_the_count_of_all(spark, cleaned):
    path = scratch_path(spark, "state")
    old, new = cleaned.filter(F.col("review_id") % 4 > 0), cleaned.filter(F.col("review_id") % 4 == 0)
    add_batch(old, path, "a")
    first = TermStatistics.merged(spark, path)
    assert first.documents == old.count()
    for _ in range(2):  # a repeated load replaces its own counts
        add_batch(new, path, "b")
    merged, whole = TermStatistics.merged(spark, path), TermStatistics.of(cleaned)
    assert merged.documents == whole.documents == cleaned.count()
    assert sorted(map(tuple, merged.words.collect())) == sorted(map(tuple, whole.words.collect()))
    assert sorted(map(tuple, tfidf(cleaned, stats=merged).collect())) == sorted(map(tuple, tfidf(cleaned).collect()))


def test_merging_does_not_read_texts(spark, cleaned):
    path = scratch_path(spark, "state")
    add_batch(cleaned, path, "a")
    assert not any("clean_text" in f for f in TermStatistics.merged(spark, path).words.columns)
    assert all("/state-" in f or "term-statistics" in f for f in TermStatistics.merged(spark, path).words.inputFiles())


def test_statistics_count_documents_without_words(spark):
    table = spark.createDataFrame([("a b a",), ("",), ("the",), ("b",)], "clean_text string")
    stats = TermStatistics.of(table)
    assert stats.documents == 4
    assert {tuple(r) for r in stats.words.select("word", "documents", "occurrences").collect()} == {("b", 2, 2)}
