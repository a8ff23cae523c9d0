from collections import Counter

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import tables
from sentiflow.operators import (
    fit_hashing,
    fit_vocab,
    hash_split,
    hashing_stages,
    load_model,
    predict,
    save_model,
    score,
)
from sentiflow.streaming import start_scoring

from .conftest import SF

CHANCES = ["negative_probability", "neutral_probability", "positive_probability"]


@pytest.fixture(scope="module")
def split(cleaned):
    return hash_split(cleaned)


@pytest.fixture(scope="module")
def model(split):
    return fit_hashing(split[0])


def chances(model, rows, key="review_id"):
    got = predict(model, rows).orderBy(key).collect()
    return np.array([[r[c] for c in CHANCES] for r in got]), np.array([r.prediction for r in got])


def test_probabilities(model, split):
    p, prediction = chances(model, split[1])
    assert np.abs(p.sum(axis=1) - 1).max() < 1e-12
    assert (p.argmax(axis=1) == prediction).all()


def test_refit_on_other_partitioning(model, split):
    again = fit_hashing(split[0].repartition(3))
    assert np.abs(chances(model, split[1])[0] - chances(again, split[1])[0]).max() < 1e-6


def test_save_and_load(model, split, tmp_path):
    save_model(model, str(tmp_path / "m"))
    loaded = load_model(str(tmp_path / "m"))
    assert (chances(model, split[1])[0] == chances(loaded, split[1])[0]).all()


def test_vocabulary_model_is_at_the_optimum(split, tmp_path):
    train = split[0]
    fitted = fit_vocab(train, size=500, max_iter=1500)
    learner = fitted.stages[-1]
    rows = fitted.transform(train).select("label", vector_to_array("features").alias("x"), vector_to_array("probability").alias("p")).collect()
    x, p = np.array([r.x for r in rows]), np.array([r.p for r in rows])
    y = np.eye(3)[[int(r.label) for r in rows]]
    gradient = (p - y).T @ x / len(rows) + learner.coefficientMatrix.toArray() / len(rows)
    assert np.abs(gradient).max() < 1e-4
    assert np.abs((p - y).mean(axis=0)).max() < 1e-4
    norms = np.linalg.norm(x, axis=1)
    assert np.allclose(norms[norms > 0], 1)
    save_model(fitted, str(tmp_path / "v"))
    again = load_model(str(tmp_path / "v"))
    assert (chances(fitted, split[1])[0] == chances(again, split[1])[0]).all()


def test_vocabulary_refit_is_the_same(split):
    words = [fit_vocab(t, size=300, max_iter=5).stages[2].vocabulary for t in (split[0], split[0].repartition(5))]
    assert words[0] == words[1]


def test_a_class_not_seen_in_training(split):
    two = fit_hashing(split[0].filter("label < 2"), max_iter=5)
    p, _ = chances(two, split[1])
    assert (p[:, 2] == 0).all() and np.allclose(p.sum(axis=1), 1)


def test_scores(spark, model):
    requests = tables.requests(spark, SF)
    rows = score(model, requests).collect()
    turns = spark.read.parquet(f"{SF}/conversations.parquet").count()
    assert len(rows) == turns and requests.count() == 2 * turns
    names = {0: "Negative", 1: "Neutral", 2: "Positive"}
    assert all(names[r.label] == r.prediction for r in rows)
    assert all(round(r[c], 4) == r[c] for r in rows for c in CHANCES)


def test_stream_equals_batch(spark, model, tmp_path):
    requests = tables.requests(spark, SF)
    requests.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    def run():
        start_scoring(model, stream, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()

    run()
    batch = score(model, requests)
    scored = spark.read.parquet(str(tmp_path / "out/status=scored"))
    assert scored.count() == batch.count()
    assert scored.select(*batch.columns).exceptAll(batch).count() == 0
    rejected = spark.read.parquet(str(tmp_path / "out/status=rejected"))
    assert rejected.count() + scored.count() == requests.count()
    # A restart finds nothing new and repeats nothing; a new file is scored once.
    run()
    assert spark.read.parquet(str(tmp_path / "out/status=scored")).count() == batch.count()
    spark.createDataFrame([("new", "very good phone")], requests.schema).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    after = spark.read.parquet(str(tmp_path / "out/status=scored"))
    assert after.filter(F.col("request_id") == "new").count() == 1
    assert after.count() == batch.count() + 1


def test_buckets_are_those_of_the_learner(cleaned):
    from pyspark.ml.feature import HashingTF

    hasher = HashingTF(inputCol="x", outputCol="y", numFeatures=8000)
    stages = hashing_stages()[:3]
    for row in Pipeline(stages=stages).fit(cleaned).transform(cleaned).limit(20).collect():
        expected = Counter(hasher.indexOf(word) for word in row.filtered_words)
        assert dict(zip(row.rawFeatures.indices.tolist(), row.rawFeatures.values.tolist())) == expected
