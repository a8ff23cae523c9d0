import json
import sys
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from checks import tables
from sentiflow import __main__ as cli
from sentiflow.operators import clean_reviews, weighted_metrics
from sentiflow.plans import analyse, export_reviews
from sentiflow.sinks import (
    latest_metrics,
    publish,
    read_metrics,
    to_documents,
    write_documents,
    write_metrics,
)

from .conftest import SF

NAMES = {
    "class_distribution",
    "metrics",
    "top_negative_words",
    "top_neutral_words",
    "top_positive_words",
    "sample_predictions",
}


def test_analysis_is_published(spark, tmp_path):
    result = analyse(tables.reviews(spark, SF), sample_n=10)
    results = result.tables()
    assert set(results) == NAMES
    paths = result.publish(str(tmp_path), "r1")
    for name, table in results.items():
        for path in (paths[name], f"{tmp_path}/latest/{name}"):
            back = spark.read.csv(path, header=True, schema=table.schema)
            assert sorted(map(str, back.collect())) == sorted(map(str, table.collect())), name
    for path in (paths["top_positive_words"], f"{tmp_path}/latest/top_positive_words"):
        (file,) = Path(path).glob("*.csv")
        header, *lines = file.read_text().splitlines()
        words = [(-int(line.split(",")[1]), line.split(",")[0]) for line in lines]
        assert header == "word,count" and words == sorted(words) and len(words) == 15
    publish({"metrics": results["metrics"]}, str(tmp_path), "r2", latest=True)
    assert spark.read.csv(paths["metrics"], header=True).count() == 1
    tested = result.predictions.count()
    assert result.report.filter("name = 'weighted avg'").first().support == tested
    assert result.confusion_matrix.agg(F.sum("count")).first()[0] == tested


def test_analysis_with_a_lexicon_and_the_other_learner(spark):
    from sentiflow.operators import fit_vocab

    lexicon = tables.lexicon(spark, SF)
    result = analyse(
        tables.reviews(spark, SF), lexicon=lexicon, fit=lambda t: fit_vocab(t, size=200, max_iter=5), mode="spark"
    )
    assert result.top_words.count() == 45
    assert result.metrics.first().Accuracy > 0


def test_documents(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x", None), (2, None, 1.5)], "review_id bigint, Reviews string, Price double")
    records = sorted(r.document for r in to_documents(rows).collect())
    assert json.loads(records[0]) == {"review_id": 1, "Reviews": "x", "Price": None}
    path = str(tmp_path / "docs")
    write_documents(rows, options={"path": path})
    write_documents(rows, options={"path": path})
    assert spark.read.schema(rows.schema).json(path).exceptAll(rows).count() == 0
    assert spark.read.json(path).count() == 2


def test_export(spark, tmp_path):
    reviews = tables.reviews(spark, SF)
    path = str(tmp_path / "docs")
    export_reviews(reviews, options={"path": path})
    assert spark.read.json(path).count() == clean_reviews(reviews).count()


def test_metrics_log(spark, tmp_path):
    path = str(tmp_path / "log")
    pred = tables.predictions(spark, SF)
    for day, run in ((2, "b"), (3, "c"), (1, "a")):
        write_metrics(weighted_metrics(pred), path, run, datetime(2024, 1, day))
    log = read_metrics(spark, path)
    assert log.count() == 3
    assert latest_metrics(log).first().run_id == "c"
    assert latest_metrics(log.filter("false")).count() == 0


def test_command_line(spark, tmp_path, monkeypatch):
    source = tables.reviews(spark, SF).drop("review_id")
    source.coalesce(2).write.csv(str(tmp_path / "csv"), header=True, escape='"')

    def run(*args):
        monkeypatch.setattr(sys, "argv", ["sentiflow", *map(str, args)])
        cli.main()

    run("analyse", tmp_path / "csv", tmp_path / "out", "--split", "stratified", "--table", tmp_path / "table")
    assert spark.read.parquet(str(tmp_path / "table")).count() == source.count()
    assert {p.name for p in (tmp_path / "out/latest").iterdir()} == NAMES
    assert read_metrics(spark, str(tmp_path / "out/metrics_log")).count() == 1
    tables.requests(spark, SF).write.parquet(str(tmp_path / "requests"))
    run("score", tmp_path / "requests", tmp_path / "out/model", tmp_path / "scores")
    scores = spark.read.parquet(str(tmp_path / "scores"))
    assert scores.filter("status = 'scored'").count() > 0
    assert scores.count() == tables.requests(spark, SF).count()
    run("export", tmp_path / "csv", "--single-line", "--option", f"path={tmp_path / 'docs'}")
    assert spark.read.json(str(tmp_path / "docs")).count() > 0
