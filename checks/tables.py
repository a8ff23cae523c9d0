"""Reviews, requests, lexicon and predictions derived from the given tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentiflow.functions import leading_bits, tokens
from sentiflow.operators import clean_reviews, min_length, with_clean_text
from sentiflow.sources import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with star ratings made from ``labels``: missing, out of range, or 1 to 5."""
    rating = (
        F.when(F.col("quality").isNull() & (F.col("doc_id") % 10 == 7), 7)
        .when(F.col("quality").isNull(), F.lit(None))
        .when((F.col("toxic") == 1) & (F.col("quality") == 0), 1)
        .when(F.col("toxic") == 1, 2)
        .when(F.col("quality") == 0, 3)
        .when(F.col("doc_id") % 2 == 0, 4)
        .otherwise(5)
    )
    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels").hint("shuffle_hash"), "doc_id", "left")
        .select(
            F.col("doc_id").alias("review_id"),
            F.col("text").alias("Reviews"),
            rating.cast("string").alias("Rating"),
            F.col("source").alias("Product Name"),
            F.col("lang").alias("Brand Name"),
            (F.col("n_chars").cast("double") / 100).alias("Price"),
        )
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_reviews(reviews(spark, sf_dir))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned texts of all documents, rated or not; only the length rule applies. They are dealt out
    by their key, as the reviews are by their join: the given file is a single split."""
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("review_id"), "text")
    documents = documents.repartition("review_id")
    return min_length(with_clean_text(documents, "text")).select("review_id", "clean_text")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn as a request, and another that cleans to nothing, made from each turn:
    empty, digits and marks, or NULL."""
    return turns_to_requests(table(spark, sf_dir, "conversations"))


def request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``requests`` as a stream. The table is a file or a folder of files; a stream takes a file by a
    pattern only."""
    schema = table(spark, sf_dir, "conversations").schema
    turns = spark.readStream.schema(schema).parquet(f"{sf_dir}/{{conversations}}.parquet")
    return turns_to_requests(turns)


def turns_to_requests(turns: DataFrame) -> DataFrame:
    name = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    nothing = F.when(F.col("turn") % 3 == 0, "").when(
        F.col("turn") % 3 == 1, F.concat(F.lit("!!! "), F.col("turn").cast("string"))
    )
    both = F.array(
        F.struct(name.alias("request_id"), F.col("text").alias("text")),
        F.struct(F.concat(name, F.lit("-nothing")).alias("request_id"), nothing.alias("text")),
    )
    return turns.select(F.inline(both))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions that SQL can repeat."""
    remainder = F.length("clean_text") % 7
    prediction = F.when(remainder == 0, 0.0).when(remainder == 1, 1.0).otherwise(2.0)
    return cleaned(spark, sf_dir).select("review_id", "clean_text", "label", prediction.alias("prediction"))


def incomplete_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with some predictions and labels missing or of no class."""
    place = F.col("review_id") % 11
    return predictions(spark, sf_dir).withColumns(
        {
            "prediction": F.when(place == 0, None).when(place == 1, 7.0).otherwise(F.col("prediction")),
            "label": F.when(place == 2, None).when(place == 3, 9.0).otherwise(F.col("label")),
        }
    )


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lexicon over all words of the corpus, stored as a table; it makes no linguistic claim."""
    forms = texts(spark, sf_dir).select(F.explode(tokens("clean_text")).alias("form")).distinct()
    third = leading_bits(F.md5("form"), 8) % 3
    entries = forms.select(
        "form",
        F.regexp_replace("form", "s$", "").alias("lemma"),
        F.when(third == 0, "ADJ").when(third == 1, "NOUN").otherwise("OTHER").alias("pos"),
    )
    return stage(entries, "lexicon")
