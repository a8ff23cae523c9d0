import hashlib
import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sentiflow.operators import (
    hash_split,
    stratified_split,
    with_hash_split,
    with_stratified_split,
)

from .conftest import plan_of


def digest(key):
    return hashlib.md5(f"42:{key}".encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed(spark):
    """Nine of ten rows in one class, one class nearly empty."""
    label = F.when(F.col("id") < 3, 0.0).when(F.col("id") % 10 == 0, 1.0).otherwise(2.0)
    return spark.range(20_000).select(F.col("id").alias("review_id"), label.alias("label")).persist()


def lowest(rows, quota):
    """Brute force: per class the first ``quota(n)`` keys by hash."""
    groups = defaultdict(list)
    for key, label in rows:
        groups[label].append((digest(key), key))
    return {k for g in groups.values() for _, k in sorted(g)[: quota(len(g))]}


def test_hash_split_ignores_partitioning(skewed):
    one = {r.review_id for r in hash_split(skewed.coalesce(1))[1].collect()}
    three = {r.review_id for r in hash_split(skewed.repartition(3))[1].collect()}
    assert one == three
    assert one == {i for i in range(20_000) if int(digest(i)[:8], 16) % 10_000 >= 8000}
    assert "Exchange" not in plan_of(with_hash_split(skewed.sparkSession.range(5), "id"))


def test_stratified_split_is_exact(skewed):
    rows = [(r.review_id, r.label) for r in skewed.collect()]
    train, test = stratified_split(skewed)
    got = {r.review_id for r in test.collect()}
    assert got == lowest(rows, lambda n: math.ceil(round(0.2 * n, 6)))
    assert train.count() + len(got) == 20_000
    moved = with_stratified_split(skewed.repartition(5)).filter("split = 'test'")
    assert got == {r.review_id for r in moved.collect()}


def test_any_label_is_a_class(spark):
    label = F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 3 == 1, -1.0)
    rows = spark.range(3000).select(F.col("id").alias("review_id"), label.alias("label"))
    tested = with_stratified_split(rows).filter("split = 'test'").groupBy("label").count().collect()
    assert {r.label: r["count"] for r in tested} == {7.0: 200, -1.0: 200, None: 200}


def test_equal_keys_stay_together(skewed):
    twice = skewed.unionByName(skewed)
    sides = with_stratified_split(twice).groupBy("review_id").agg(F.count_distinct("split").alias("n"))
    assert sides.filter("n > 1").count() == 0


def test_rows_are_ranked_only_within_one_bucket(skewed):
    # The window runs above a join with the class's last bucket, so below it most rows are gone.
    plan = with_stratified_split(skewed)._jdf.queryExecution().optimizedPlan().toString()
    ranked = plan[plan.index("row_number") :]
    assert "Join Inner" in ranked
