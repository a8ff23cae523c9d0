"""The full analysis: clean, split, train, evaluate, summarise."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import SEED, SENTIMENTS, TOP_WORDS, TRAIN_SHARE
from ..operators.evaluate import (
    class_distribution,
    classification_report,
    confusion_matrix,
    metrics_row,
    outcome_counts,
    weighted_metrics,
)
from ..operators.keywords import keywords_top
from ..operators.models import fit_hashing, predict
from ..operators.observed import observed_cleaning, observed_row
from ..operators.split import train_and_test, with_hash_split, with_stratified_split
from ..operators.summary import sample_predictions, top_words
from ..sinks.publish import publish
from ..sources.storage import remove, scratch_path, stage


@dataclass(frozen=True)
class Analysis:
    """Results of a run. Reviews, predictions and what the reports are made of are staged: top words,
    one row of outcome counts, the class counts and the samples. Reports read these few rows, and
    publishing them does not read the corpus again."""

    reviews: DataFrame  # key, cleaned text, label and split, staged
    predictions: DataFrame  # scored test reviews, staged
    model: PipelineModel
    class_distribution: DataFrame
    metrics: DataFrame
    report: DataFrame
    confusion_matrix: DataFrame
    top_words: DataFrame
    samples: DataFrame
    folder: str  # of everything staged
    funnel: DataFrame  # rows left after each cleaning step, counted while the reviews were written

    def close(self) -> None:
        """Remove what was staged. The model stays; all tables of the result go."""
        remove(self.reviews.sparkSession, self.folder)

    def tables(self) -> dict[str, DataFrame]:
        """The six result tables, by the name they are published under."""
        tables = {
            "class_distribution": self.class_distribution.select(
                F.col("sentiment").alias("label"), "count"
            ),
            "metrics": metrics_row(self.metrics),
        }
        for class_id, name in SENTIMENTS.items():
            words = self.top_words.filter(F.col("label") == class_id)
            tables[_words_table(name)] = words.select("word", "count")
        tables["sample_predictions"] = self.samples
        return tables

    def publish(self, out_dir: str, run_id: str, latest: bool = True) -> dict[str, str]:
        """Write the result tables as CSV, rows in reading order."""
        by_count = [F.desc("count"), "word"]
        order = {_words_table(name): by_count for name in SENTIMENTS.values()}
        order |= {"class_distribution": ["label"], "sample_predictions": self.samples.columns[:1]}
        return publish(self.tables(), out_dir, run_id, latest, order)


def _words_table(sentiment: str) -> str:
    return f"top_{sentiment.lower()}_words"


def analyse(
    reviews: DataFrame,
    key: str = "review_id",
    lexicon: DataFrame | None = None,
    top_n: int = TOP_WORDS,
    sample_n: int = 50,
    train_share: float = TRAIN_SHARE,
    seed: int = SEED,
    mode: str = "trimmed",
    fit: Callable[[DataFrame], PipelineModel] = fit_hashing,
    stratified: bool = False,
) -> Analysis:
    """Raw reviews to an ``Analysis``.

    Cleaning runs once: key, text and label are staged in shared storage by split, and each later
    step reads only the columns and the part it needs. So are the predictions, without features.
    ``stratified`` takes the exact split by class, which reads the cleaned reviews once more, instead
    of the hash split. Metrics, report and confusion matrix use every test row. With a ``lexicon`` the
    top words are keywords, otherwise plain words without stop words.
    """
    folder = scratch_path(reviews.sparkSession, "analysis")
    observed, counted = observed_cleaning(reviews, mode)
    texts = observed.select(key, "clean_text", "label")
    if stratified:
        texts = stage(texts, "texts", under=folder)
        texts = with_stratified_split(texts, "label", key, train_share, seed)
    else:
        texts = with_hash_split(texts, key, train_share, seed)
    cleaned = stage(texts, "reviews", ("split",), folder)
    train, test = train_and_test(cleaned)
    model = fit(train)
    predictions = stage(predict(model, test.select(key, "clean_text", "label")), "predictions", under=folder)
    counts = stage(outcome_counts(predictions), "outcomes", under=folder)
    if lexicon is None:
        words = top_words(cleaned, top_n, stop_sets=("custom", "canonical"))
    else:
        words = keywords_top(cleaned, lexicon, top_n)
    return Analysis(
        reviews=cleaned,
        predictions=predictions,
        model=model,
        class_distribution=stage(class_distribution(cleaned), "classes", under=folder),
        metrics=weighted_metrics(counts),
        report=classification_report(counts),
        confusion_matrix=confusion_matrix(counts),
        top_words=stage(words, "words", under=folder),
        samples=stage(sample_predictions(predictions, sample_n, key), "samples", under=folder),
        folder=folder,
        funnel=observed_row(reviews.sparkSession, counted),
    )
