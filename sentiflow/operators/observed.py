"""Counts taken while a table is written.

``review_funnel`` and counts of rejects scan their input once more. Here the same counters ride on the
job that writes the cleaned rows: every task adds to them what it sees, and the counts are there when
the job ends. Between them and the file write there is no shuffle, so a task that is repeated after a
loss counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import EMPTY_TEXT, MIN_CLEAN_LENGTH
from ..functions.ratings import is_valid_rating, label_from_rating
from ..functions.text import clean_text, with_computed
from .prepare import empty_after_cleaning, project_reviews, with_clean_text

FUNNEL = ("raw", "with_text_and_rating", "valid_rating", "cleaned")
REQUESTS = ("scored", "rejected")


def observed_cleaning(
    df: DataFrame, mode: str = "trimmed", min_chars: int = MIN_CLEAN_LENGTH
) -> tuple[DataFrame, Observation]:
    """The rows of ``clean_reviews``, and the counts of ``review_funnel`` once they have been written.

    The first action over the rows fills the observation (see ``observed_row``). Text is cleaned once,
    for rows with a rating only.
    """
    present = F.col("Reviews").isNotNull() & F.col("Rating").isNotNull()
    rated = present & F.coalesce(is_valid_rating("Rating"), F.lit(False))
    flagged = project_reviews(df).withColumns({"_present": present, "_rated": rated})
    cleaned = with_computed(flagged, "clean_text", F.when(F.col("_rated"), clean_text("Reviews", mode)))
    kept = F.col("_rated") & (F.length("clean_text") > min_chars)
    counts = (F.lit(True), F.col("_present"), F.col("_rated"), kept)
    funnel = Observation()
    observed = cleaned.observe(funnel, *(F.count_if(c).alias(name) for name, c in zip(FUNNEL, counts)))
    return observed.filter(kept).drop("_present", "_rated").withColumn("label", label_from_rating("Rating")), funnel


def observed_requests(requests: DataFrame, text: str = "text") -> tuple[DataFrame, Observation]:
    """Every request with its cleaned text and ``error``, null where it has words; accepted and
    rejected ones are counted by the first action over them."""
    rejected = empty_after_cleaning()
    told = with_clean_text(requests, text).withColumn("error", F.when(rejected, EMPTY_TEXT))
    counts = Observation()
    return told.observe(counts, F.count_if(~rejected).alias("scored"), F.count_if(rejected).alias("rejected")), counts


def observed_row(spark: SparkSession, counts: Observation, names: tuple[str, ...] = FUNNEL) -> DataFrame:
    """The counts as one row. Waits for the action that fills them, so call it after that."""
    found = counts.get
    schema = ", ".join(f"{name} bigint" for name in names)
    return spark.createDataFrame([tuple(int(found[name]) for name in names)], schema)
