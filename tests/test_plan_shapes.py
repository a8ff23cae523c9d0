"""What the plans must look like for the work to scale."""

from pyspark.sql import functions as F

from checks import tables
from sentiflow.operators import (
    clean_reviews,
    keywords_top,
    split_rejects,
    tfidf,
    vocab_tfidf,
    train_and_test,
    with_hash_split,
)
from sentiflow.plans import analyse
from sentiflow.sources import stage

from .conftest import SF, optimized, plan_of


def test_text_is_cleaned_once_per_row(spark):
    assert optimized(clean_reviews(tables.reviews(spark, SF))).count("regexp_replace") == 1
    for part in split_rejects(tables.requests(spark, SF)):
        assert optimized(part).count("regexp_replace") == 1


def test_cleaning_reads_only_its_columns_and_does_not_shuffle(spark):
    raw = spark.read.parquet(f"{SF}/documents.parquet").select(
        F.col("text").alias("Reviews"), F.lit("5").alias("Rating"), F.col("source").alias("Product Name"),
        F.col("lang").alias("Brand Name"), F.col("n_chars").cast("double").alias("Price"), "doc_id",
    )
    plan = plan_of(clean_reviews(raw).select("clean_text", "label"))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<text:string>" in plan


def test_training_reads_only_training_files(cleaned):
    staged = stage(with_hash_split(cleaned), "pruning", ("split",))
    train, test = train_and_test(staged)
    assert train.count() + test.count() == cleaned.count()
    assert "PartitionFilters: [isnotnull(split" in plan_of(train)


def test_no_cross_joins(spark, cleaned):
    lexicon = tables.lexicon(spark, SF)
    for result in (tfidf(cleaned), tfidf(cleaned, broadcast_bytes=0, hot_keys=100), keywords_top(cleaned, lexicon)):
        plan = plan_of(result)
        assert "Cartesian" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_vocabulary_weights_do_not_shuffle_documents(cleaned):
    plan = plan_of(vocab_tfidf(cleaned, size=100))
    assert plan.count("Exchange") == 1 and "BroadcastExchange" in plan


def test_reports_do_not_read_the_corpus_again(spark):
    result = analyse(tables.reviews(spark, SF), sample_n=5)
    for name, table in result.tables().items():
        files = table.inputFiles()
        assert files and not any("/reviews/" in f or "documents.parquet" in f for f in files), name
    assert set(result.reviews.columns) == {"review_id", "clean_text", "label", "split"}
    result.close()
