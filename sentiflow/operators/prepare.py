"""Cleaning and labelling of review tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import EMPTY_TEXT, MIN_CLEAN_LENGTH
from ..functions.ratings import is_valid_rating, label_from_rating
from ..functions.text import clean_text, with_computed
from ..sources.reviews import REVIEW_COLUMNS


def project_reviews(df: DataFrame) -> DataFrame:
    """The five review columns, and ``review_id`` where there is one."""
    key = ["review_id"] if "review_id" in df.columns else []
    return df.select(*key, *(F.col(f"`{c}`") for c in REVIEW_COLUMNS))


def drop_missing(df: DataFrame, cols: tuple[str, ...] = ("Reviews", "Rating")) -> DataFrame:
    return df.dropna(subset=list(cols))


def valid_rating(df: DataFrame, col: str = "Rating") -> DataFrame:
    """Rows rated 1 to 5."""
    return df.filter(is_valid_rating(col))


def with_clean_text(df: DataFrame, col: str = "Reviews", mode: str = "trimmed") -> DataFrame:
    """Add ``clean_text``; length and emptiness filters on it do not run the regex again."""
    return with_computed(df, "clean_text", clean_text(f"`{col}`", mode))


def min_length(df: DataFrame, n: int = MIN_CLEAN_LENGTH, col: str = "clean_text") -> DataFrame:
    """Rows whose text is longer than ``n`` characters."""
    return df.filter(F.length(col) > n)


def with_label(df: DataFrame, col: str = "Rating") -> DataFrame:
    """Add ``label`` and drop the rows that have none."""
    return df.withColumn("label", label_from_rating(col)).dropna(subset=["label"])


def clean_reviews(df: DataFrame, mode: str = "trimmed", min_chars: int = MIN_CLEAN_LENGTH) -> DataFrame:
    """Raw reviews to cleaned, labelled reviews: one narrow stage, no shuffle.

    The cheap rating test runs before any text is touched. It leaves only ratings that have a class,
    so no row needs to be dropped for its label.
    """
    rated = valid_rating(drop_missing(project_reviews(df)))
    long_enough = min_length(with_clean_text(rated, mode=mode), min_chars)
    return long_enough.withColumn("label", label_from_rating("Rating"))


def for_class(df: DataFrame, label: float) -> DataFrame:
    return df.filter(F.col("label") == F.lit(float(label)))


def review_funnel(df: DataFrame, mode: str = "trimmed", min_chars: int = MIN_CLEAN_LENGTH) -> DataFrame:
    """Rows left after each cleaning step, all counted in one scan."""
    present = F.col("Reviews").isNotNull() & F.col("Rating").isNotNull()
    rated = present & F.coalesce(is_valid_rating("Rating"), F.lit(False))
    # CASE is lazy: text is cleaned only for rows that got this far.
    long_enough = F.when(rated, F.length(clean_text("Reviews", mode)) > min_chars)
    return df.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(present).alias("with_text_and_rating"),
        F.count_if(rated).alias("valid_rating"),
        F.count_if(long_enough).alias("cleaned"),
    )


def empty_after_cleaning(col: Column | str = "clean_text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")) == ""


def split_rejects(requests: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)`` requests; rejected ones have nothing left after cleaning.

    Works the same on a streaming table.
    """
    cleaned = with_clean_text(requests, text)
    rejected = cleaned.filter(empty_after_cleaning()).withColumn(
        "error", F.lit(EMPTY_TEXT)
    )
    return cleaned.filter(~empty_after_cleaning()), rejected
