"""Replacement of collections, splits that are fitted once, and the order of reports."""

import pytest
from pyspark.sql import functions as F

from sentiflow.operators import chart_words, class_distribution, split_thresholds, top_words, with_fitted_split, with_stratified_split
from sentiflow.sinks import read_collection, replace_collection, versions
from sentiflow.sources import names_in, stage

SCHEMA = "id bigint, text string, note string"


def rows(spark, n, text):
    return spark.range(n).select("id", F.lit(text).alias("text"), F.lit(None).cast("string").alias("note")).repartition(4)


def held(spark, path):
    return sorted((r.id, r.text, r.note) for r in read_collection(spark, path, SCHEMA).collect())


def test_a_failing_task_leaves_the_old_documents(spark, tmp_path):
    path = str(tmp_path / "docs")
    assert held(spark, path) == []
    replace_collection(rows(spark, 20, "old"), path)
    old = held(spark, path)
    broken = rows(spark, 50, "new").withColumn("text", F.when(F.col("id") == 33, F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        replace_collection(broken, path)
    assert held(spark, path) == old and len(old) == 20
    replace_collection(rows(spark, 50, "new"), path)
    assert held(spark, path) == [(i, "new", None) for i in range(50)]
    assert versions(spark, path) == [f"{path}/{n}" for n in names_in(spark, path)]  # nothing is left of the failed one


def test_versions_are_kept_for_readers_that_have_begun(spark, tmp_path):
    path = str(tmp_path / "docs")
    replace_collection(rows(spark, 3, "v1"), path)
    reading = read_collection(spark, path, SCHEMA)
    replace_collection(rows(spark, 4, "v2"), path)
    assert reading.count() == 3 and len(held(spark, path)) == 4
    # A replacement may read what it replaces.
    replace_collection(read_collection(spark, path, SCHEMA).withColumn("text", F.lit("v3")), path, keep=1)
    assert held(spark, path) == [(i, "v3", None) for i in range(4)] and len(versions(spark, path)) == 1


def test_a_fitted_split_does_not_move_rows(spark, cleaned):
    first, later = cleaned.filter(F.col("review_id") % 3 != 0), cleaned.filter(F.col("review_id") % 3 == 0)
    fitted = stage(split_thresholds(first), "thresholds")
    alone = {r.review_id: r.split for r in with_fitted_split(first, fitted).collect()}
    exact = {r.review_id: r.split for r in with_stratified_split(first).collect()}
    both = {r.review_id: r.split for r in with_fitted_split(cleaned, fitted).collect()}
    assert alone == exact and len(both) == cleaned.count() == len(alone) + later.count()
    assert all(both[i] == side for i, side in alone.items())
    assert {r.review_id: r.split for r in with_fitted_split(later.repartition(3), fitted).collect()} == {i: s for i, s in both.items() if i not in alone}


def test_a_fitted_split_takes_classes_it_has_not_seen(spark, cleaned):
    fitted = stage(split_thresholds(cleaned.filter("label <> 1")), "thresholds")
    assert fitted.count() == 2
    unseen = with_fitted_split(cleaned.withColumn("label", F.lit(None).cast("double")), fitted)
    sides = {r.split: r["count"] for r in unseen.groupBy("split").count().collect()}
    assert sum(sides.values()) == cleaned.count() and set(sides) == {"train", "test"}


def test_reports_come_in_their_order(cleaned):
    top = top_words(cleaned)
    chart = [tuple(r) for r in chart_words(top).select("label", "count", "word").collect()]
    backwards = lambda word: tuple(-ord(c) for c in word) + (1,)
    assert chart == sorted(chart, key=lambda r: (r[0], r[1], backwards(r[2]))) and len(chart) == 30
    assert [r.sentiment for r in class_distribution(cleaned).collect()] == ["Negative", "Neutral", "Positive"]
