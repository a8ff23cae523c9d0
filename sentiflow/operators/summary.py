"""Word counts, top words and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    CHART_WORDS,
    DOMAIN_STOPWORDS,
    ENGLISH_STOPWORDS,
    MIN_KEYWORD_LENGTH,
    TOP_WORDS,
)
from ..functions.ratings import sentiment_name
from ..functions.text import tokens


def domain_words(stop_sets: tuple[str, ...]) -> list[str]:
    """The union of the named domain lists (``custom``, ``canonical``)."""
    return sorted({word for name in stop_sets for word in DOMAIN_STOPWORDS[name]})


def token_rows(df: DataFrame, text: str = "clean_text", keep: tuple[str, ...] = ("label",)) -> DataFrame:
    """One row per token that is not an English stop word and is longer than two letters.

    Tokens are exploded before they are tested, so the test is a compiled filter and not a lambda.
    """
    rows = df.select(*keep, F.explode(tokens(text)).alias("form"))
    return rows.filter(
        (F.length("form") > MIN_KEYWORD_LENGTH) & ~F.col("form").isin(*ENGLISH_STOPWORDS)
    )


def word_counts(
    df: DataFrame, text: str = "clean_text", stop_sets: tuple[str, ...] = ()
) -> DataFrame:
    """``(label, word, count)`` over all classes at once; counted per task before the shuffle."""
    words = token_rows(df, text).withColumnRenamed("form", "word")
    if stop_sets:
        words = words.filter(~F.col("word").isin(*domain_words(stop_sets)))
    return words.groupBy("label", "word").agg(F.count(F.lit(1)).alias("count"))


def rank_words(counts: DataFrame, n: int = TOP_WORDS) -> DataFrame:
    """The ``n`` most frequent words of each class, ties by word.

    ``row_number() <= n`` lets Spark keep only ``n`` rows per class and task before the shuffle.
    """
    by_count = W.partitionBy("label").orderBy(F.desc("count"), "word")
    return (
        counts.withColumn("rank", F.row_number().over(by_count))
        .filter(F.col("rank") <= n)
        .select("label", "rank", "word", "count")
    )


def top_words(
    df: DataFrame,
    n: int = TOP_WORDS,
    text: str = "clean_text",
    stop_sets: tuple[str, ...] = (),
) -> DataFrame:
    """Top words of every class, counted over all its reviews."""
    return rank_words(word_counts(df, text, stop_sets), n)


def chart_words(top: DataFrame, n: int = CHART_WORDS) -> DataFrame:
    """The first ``n`` words of each class in ascending order, as charts draw them."""
    return top.filter(F.col("rank") <= n).orderBy("label", "count", F.desc("word"))


def sample_predictions(pred: DataFrame, n: int = 30, key: str = "review_id") -> DataFrame:
    """The first ``n`` predictions by key, with class names."""
    extra = [c for c in pred.columns if c.endswith("_probability")]
    return (
        pred.select(key, "clean_text", "label", "prediction", *extra)
        .orderBy(key)
        .limit(n)
        .withColumn("actual_sentiment", sentiment_name("label"))
        .withColumn("predicted_sentiment", sentiment_name("prediction"))
    )
