"""Streams that are scored by versions of a model."""

import pytest
from pyspark.sql import functions as F

from checks import tables
from sentiflow.operators import fit_hashing, load_model, score_or_reject
from sentiflow.sources import names_in
from sentiflow.streaming import add_model_version, model_versions, read_batch_log, read_scored, start_versioned_scoring
from sentiflow.streaming.versions import _Batches

from .conftest import SF


@pytest.fixture(scope="module")
def models(cleaned):
    always = cleaned.withColumn("label", F.when(F.col("review_id") % 50 == 0, F.col("label")).otherwise(0.0))
    return fit_hashing(cleaned), fit_hashing(always)


def test_the_next_batch_takes_the_new_model(spark, models, tmp_path):
    source, out, place = (str(tmp_path / n) for n in ("requests", "out", "models"))
    schema = "request_id string, text string"
    requests = tables.requests(spark, SF).select("request_id", "text")
    half = F.crc32("request_id") % 2
    first = add_model_version(models[0], place, spark)

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        start_versioned_scoring(place, stream, out, str(tmp_path / "checkpoint")).awaitTermination()

    requests.filter(half == 0).write.parquet(source)
    run()
    second = add_model_version(models[1], place, spark)
    assert model_versions(spark, place) == [first, second] and first < second
    requests.filter(half == 1).write.mode("append").parquet(source)
    run()
    run()  # nothing new
    rows, log = read_scored(spark, out), read_batch_log(spark, out).orderBy("batch_id").collect()
    assert [(r.model_version, r.requests) for r in log] == [
        (first, requests.filter(half == 0).count()),
        (second, requests.filter(half == 1).count()),
    ]
    assert all(r.requests == r.rejected + r.negative + r.neutral + r.positive for r in log)
    for n, version, model in ((0, first, models[0]), (1, second, models[1])):
        expected = score_or_reject(load_model(f"{place}/{version}"), requests.filter(half == n))
        found = rows.filter(F.col("model_version") == version).select(*expected.columns)
        assert found.exceptAll(expected).count() == 0 == expected.exceptAll(found).count()


def test_a_replayed_batch_writes_nothing_twice(spark, models, tmp_path):
    out, place = str(tmp_path / "out"), str(tmp_path / "models")
    requests = tables.requests(spark, SF).select("request_id", "text")
    first = add_model_version(models[0], place, spark)
    batches = _Batches(place, out, "text")
    batches(requests, 0)
    # The job ended between the rows and the log, and a new model has come since.
    broken = str(tmp_path / "broken")
    score_or_reject(models[0], requests).withColumn("model_version", F.lit(first)).write.parquet(f"{broken}/rows/batch_id=0")
    second = add_model_version(models[1], place, spark)
    for folder in (out, broken):
        again = _Batches(place, folder, "text")
        again(requests, 0)
        again(requests, 0)
        assert read_scored(spark, folder).count() == requests.count()
        (line,) = read_batch_log(spark, folder).collect()
        assert line.model_version == first and line.requests == requests.count()
    # A batch that failed while writing rows is written as a whole.
    bad = requests.withColumn("text", F.when(F.crc32("request_id") % 3 == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        batches(bad, 1)
    batches(requests, 1)
    batches(requests.limit(0), 2)  # an empty batch
    assert read_scored(spark, out).groupBy("batch_id", "model_version").count().orderBy("batch_id").collect() == [
        (0, first, requests.count()),
        (1, second, requests.count()),
    ]
    assert [r.requests for r in read_batch_log(spark, out).orderBy("batch_id").collect()] == [requests.count()] * 2 + [0]


def test_versions_that_are_not_complete_do_not_count(spark, models, tmp_path):
    place = str(tmp_path / "models")
    with pytest.raises(ValueError, match="no model"):
        _Batches(place, str(tmp_path / "out"), "text")(spark.createDataFrame([("a", "b")], "request_id string, text string"), 0)
    names = [add_model_version(models[0], place, spark, keep=2) for _ in range(3)]
    models[1].write().save(f"{place}/unfinished-version-9999999999-x")
    assert model_versions(spark, place) == names[1:] and len(names_in(spark, place)) == 3
