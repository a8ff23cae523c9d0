import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from checks import tables
from sentiflow.operators import (
    class_distribution,
    classification_report,
    confusion_matrix,
    metrics_long,
    metrics_row,
    outcome_counts,
    unmatched_rows,
    weighted_metrics,
)

from .conftest import SF, plan_of


@pytest.fixture(scope="module", params=["surrogate", "always positive", "no neutral"])
def pred(request, spark):
    rows = tables.predictions(spark, SF).select("label", "prediction")
    if request.param == "always positive":
        rows = rows.withColumn("prediction", F.lit(2.0))
    if request.param == "no neutral":
        rows = rows.filter("label <> 1")
    return rows.persist()


def test_metrics_equal_the_evaluator(pred):
    got = weighted_metrics(pred).first()
    evaluator = MulticlassClassificationEvaluator()
    names = {"Accuracy": "accuracy", "F1": "f1", "Precision": "weightedPrecision", "Recall": "weightedRecall"}
    for ours, theirs in names.items():
        assert got[ours] == pytest.approx(evaluator.evaluate(pred, {evaluator.metricName: theirs}), abs=1e-9)


def test_matrix_has_all_cells(pred):
    cells = {(r.label, r.prediction): r["count"] for r in confusion_matrix(pred).collect()}
    counts = {(r.label, r.prediction): r["count"] for r in pred.groupBy("label", "prediction").count().collect()}
    assert len(cells) == 9
    assert {k: n for k, n in cells.items() if n} == counts
    wide = confusion_matrix(pred, wide=True).collect()
    assert [r.actual_sentiment for r in wide] == ["Negative", "Neutral", "Positive"]
    assert wide[0].predicted_positive == cells[0.0, 2.0]


def test_report(pred):
    report = {r.name: r for r in classification_report(pred).collect()}
    metrics = weighted_metrics(pred).first()
    assert list(report) == ["Negative", "Neutral", "Positive", "accuracy", "macro avg", "weighted avg"]
    assert report["accuracy"].f1 == pytest.approx(metrics.Accuracy)
    assert report["weighted avg"].f1 == pytest.approx(metrics.F1)
    assert report["weighted avg"].support == pred.count()
    macro = sum(report[c].recall for c in ("Negative", "Neutral", "Positive")) / 3
    assert report["macro avg"].recall == pytest.approx(macro)


def test_rows_without_a_match_are_counted(spark):
    rows = [(0.0, 0.0), (0.0, None), (1.0, 5.0), (2.0, 2.0), (None, 1.0), (9.0, 2.0)]
    pred = spark.createDataFrame(rows, "label double, prediction double")
    counts = outcome_counts(pred)
    metrics = weighted_metrics(pred).first()
    assert metrics.Accuracy == 0.5 and tuple(weighted_metrics(counts).first()) == tuple(metrics)
    assert tuple(unmatched_rows(counts).first()) == (2, 2)
    report = {r.name: r.support for r in classification_report(counts).collect()}
    assert report["Negative"] == 2 and report["Neutral"] == 1 and report["weighted avg"] == 4


def test_no_rows(pred):
    empty = pred.filter("false")
    assert [r["count"] for r in confusion_matrix(empty).collect()] == [0] * 9
    assert tuple(weighted_metrics(empty).first()) == (0.0, 0.0, 0.0, 0.0)
    assert [r["count"] for r in class_distribution(empty).collect()] == [0, 0, 0]


def test_one_exchange_of_one_row_per_task(cleaned):
    for result in (class_distribution(cleaned), confusion_matrix(cleaned, prediction="label")):
        assert plan_of(result).count("Exchange") == 1
        assert "Join" not in plan_of(result)


def test_shaping(pred):
    row = metrics_row(weighted_metrics(pred))
    long = metrics_long(row).collect()
    assert [r.Metric for r in long] == ["Accuracy", "F1", "Precision", "Recall"]
    assert [r.Score for r in long] == list(row.first())
    assert all(round(r.Score, 4) == r.Score for r in long)
