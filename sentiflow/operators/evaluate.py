"""Evaluation of predictions, from counters filled in one scan.

There are three classes, so the whole confusion matrix is one row of conditional counts: one partial
aggregation per task and one row per task shuffled. Everything else is arithmetic on that row. Cells
without rows are zero without any join.

Every function takes predictions, or their ``outcome_counts`` where these are kept.

A labelled row without a known prediction is a row its class does not get right: it counts as support
and in every denominator of recall and accuracy. ``unmatched_rows`` says how many there are, and how
many rows have no known label and so cannot be evaluated.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import SENTIMENTS
from ..functions.ratings import sentiment_name

_CLASSES = list(SENTIMENTS)


def _cell(actual: float, predicted: float) -> str:
    return f"actual_{int(actual)}_predicted_{int(predicted)}"


def _missed(actual: float) -> str:
    return f"actual_{int(actual)}_unpredicted"


def outcome_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: rows by true and predicted class, without a known prediction, and without a label."""
    predicted = F.coalesce(F.col(prediction).isin(*_CLASSES), F.lit(False))
    labelled = F.coalesce(F.col(label).isin(*_CLASSES), F.lit(False))
    return pred.agg(
        *(
            F.count_if((F.col(label) == a) & (F.col(prediction) == p)).alias(_cell(a, p))
            for a in _CLASSES
            for p in _CLASSES
        ),
        *(F.count_if((F.col(label) == a) & ~predicted).alias(_missed(a)) for a in _CLASSES),
        F.count_if(~labelled).alias("unlabelled"),
    )


def _counts(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    return pred if "unlabelled" in pred.columns else outcome_counts(pred, label, prediction)


def unmatched_rows(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: ``unpredicted``, labelled rows without a known prediction, and ``unlabelled`` rows."""
    missed = _total([F.col(_missed(a)) for a in _CLASSES])
    return _counts(pred, label, prediction).select(missed.alias("unpredicted"), "unlabelled")


def _total(cells: list[Column]) -> Column:
    return reduce(add, cells)


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


class _ClassScores:
    """Expressions for one class over the row of counters."""

    def __init__(self, class_id: float):
        self.name = SENTIMENTS[class_id]
        hits = F.col(_cell(class_id, class_id))
        self.hits = hits
        self.support = _total([F.col(_cell(class_id, p)) for p in _CLASSES] + [F.col(_missed(class_id))])
        self.precision = _ratio(hits, _total([F.col(_cell(a, class_id)) for a in _CLASSES]))
        self.recall = _ratio(hits, self.support)
        self.f1 = _ratio(2 * self.precision * self.recall, self.precision + self.recall)


def _scores() -> tuple[list[_ClassScores], Column, Column]:
    classes = [_ClassScores(c) for c in _CLASSES]
    rows = _total([c.support for c in classes])
    accuracy = _ratio(_total([c.hits for c in classes]), rows)
    return classes, rows, accuracy


def _weighted(classes: list[_ClassScores], measure: str, rows: Column) -> Column:
    return _ratio(_total([getattr(c, measure) * c.support for c in classes]), rows)


def confusion_matrix(
    pred: DataFrame, wide: bool = False, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """All nine cells, long ``(label, prediction, count)`` or one row per true class. Rows without a
    known label or prediction are in no cell; ``unmatched_rows`` counts them."""
    counts = _counts(pred, label, prediction)
    if wide:
        rows = [
            F.struct(
                F.lit(SENTIMENTS[a]).alias("actual_sentiment"),
                *(F.col(_cell(a, p)).alias(f"predicted_{SENTIMENTS[p].lower()}") for p in _CLASSES),
            )
            for a in _CLASSES
        ]
    else:
        rows = [
            F.struct(
                F.lit(a).alias("label"), F.lit(p).alias("prediction"), F.col(_cell(a, p)).alias("count")
            )
            for a in _CLASSES
            for p in _CLASSES
        ]
    return counts.select(F.inline(F.array(*rows)))


def weighted_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: Accuracy, F1, Precision, Recall, weighted by class support."""
    classes, rows, accuracy = _scores()
    return _counts(pred, label, prediction).select(
        accuracy.alias("Accuracy"),
        _weighted(classes, "f1", rows).alias("F1"),
        _weighted(classes, "precision", rows).alias("Precision"),
        _weighted(classes, "recall", rows).alias("Recall"),
    )


def classification_report(
    pred: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Per-class scores, then accuracy (in the ``f1`` column), macro and weighted averages."""
    classes, rows, accuracy = _scores()
    nothing = F.lit(None).cast("double")

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    def macro(measure: str) -> Column:
        return _total([getattr(c, measure) for c in classes]) / len(classes)

    measures = ["precision", "recall", "f1"]
    lines = [line(c.name, c.precision, c.recall, c.f1, c.support) for c in classes]
    lines.append(line("accuracy", nothing, nothing, accuracy, rows))
    lines.append(line("macro avg", *(macro(m) for m in measures), rows))
    lines.append(line("weighted avg", *(_weighted(classes, m, rows) for m in measures), rows))
    return _counts(pred, label, prediction).select(F.inline(F.array(*lines)))


def metrics_row(metrics: DataFrame, digits: int = 4) -> DataFrame:
    """The metrics rounded for publishing."""
    return metrics.select(*(F.round(c, digits).alias(c) for c in metrics.columns))


def metrics_long(metrics: DataFrame) -> DataFrame:
    """One row per metric: ``Metric``, ``Score``."""
    return metrics.unpivot([], metrics.columns, "Metric", "Score")


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class in class order; always three rows, zero where a class is absent."""
    counts = df.agg(*(F.count_if(F.col(label) == c).alias(f"class_{int(c)}") for c in _CLASSES))
    rows = [
        F.struct(
            F.lit(c).alias("label"),
            sentiment_name(F.lit(c)).alias("sentiment"),
            F.col(f"class_{int(c)}").alias("count"),
        )
        for c in _CLASSES
    ]
    return counts.select(F.inline(F.array(*rows)))
