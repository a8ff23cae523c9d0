import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from sentiflow.functions import (
    clean_text,
    label_from_rating,
    remove_stopwords,
    sentiment_name,
    tokens,
)
from sentiflow.functions.fixed_values import (
    CANONICAL_STOPWORDS,
    CUSTOM_STOPWORDS,
    ENGLISH_STOPWORDS,
)
from sentiflow.operators import clean_reviews, review_funnel, split_rejects

REVIEW = "review_id bigint, Reviews string, Rating string, `Product Name` string, `Brand Name` string, Price double"


def two_pass(text):
    """Blank everything but letters and whitespace, then collapse whitespace."""
    kept = re.sub(r"[^a-zA-Z\s]", " ", text.lower())
    return re.sub(r"\s+", " ", kept).strip()


def cleaned_values(spark, texts, mode="trimmed"):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(clean_text("t", mode)).collect()]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=60), min_size=40, max_size=80))
def test_one_pass_equals_two(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert cleaned_values(spark, texts) == [two_pass(t) for t in texts]


def test_cleaning_modes(spark):
    texts = ["  ok a  ", "It's  GREAT!\n10/10", "İstanbul", "Kelvin", "!!! 123", None]
    assert cleaned_values(spark, texts) == ["ok a", "it s great", "i stanbul", "kelvin", "", ""]
    assert cleaned_values(spark, texts, "spark") == [" ok a ", "it s great ", " stanbul", " elvin", " ", None]


def test_tokens_follow_the_learner(spark):
    rows = spark.createDataFrame([("the phone is great and the screen is not",), ("",), ("a b",)], "clean_text string")
    words = Tokenizer(inputCol="clean_text", outputCol="w").transform(rows)
    words = StopWordsRemover(inputCol="w", outputCol="f").transform(words)
    same = words.filter((F.col("w") == tokens("clean_text")) & (F.col("f") == remove_stopwords(tokens("clean_text"))))
    assert same.count() == 3


def test_word_lists(spark):
    assert ENGLISH_STOPWORDS == StopWordsRemover.loadDefaultStopWords("english")
    assert (len(CUSTOM_STOPWORDS), len(CANONICAL_STOPWORDS)) == (11, 56)
    assert len({*CUSTOM_STOPWORDS, *CANONICAL_STOPWORDS}) == 58


def test_labels(spark):
    ratings = ["1", "2", "3", "4", "5", "5.0", "7", "0", "4.5", "abc", "", None]
    rows = spark.createDataFrame(list(enumerate(ratings)), "i int, Rating string").orderBy("i")
    labels = [r[0] for r in rows.select(label_from_rating()).collect()]
    assert labels == [0.0, 0.0, 1.0, 2.0, 2.0, 2.0] + [None] * 6
    names = [r[0] for r in rows.select(sentiment_name(label_from_rating())).collect()]
    assert names == ["Negative", "Negative", "Neutral"] + ["Positive"] * 3 + ["Unknown"] * 6


def test_cleaning_and_funnel_agree(spark):
    texts = [("good one", "5"), ("ok", "5"), ("  ok a  ", "4"), (None, "3"), ("fine thing", None), ("fine thing", "7"), ("fine thing", "abc"), ("bad thing", "1")]
    rows = spark.createDataFrame(
        [(i, t, r, "p", None, None) for i, (t, r) in enumerate(texts)], REVIEW
    )
    kept = {r.review_id: r.label for r in clean_reviews(rows).collect()}
    assert kept == {0: 2.0, 7: 0.0}
    untrimmed = {r.review_id for r in clean_reviews(rows, mode="spark").collect()}
    assert untrimmed == {0, 2, 7}
    assert tuple(review_funnel(rows).first()) == (8, 6, 4, 2)
    assert tuple(review_funnel(rows, mode="spark").first()) == (8, 6, 4, 3)


def test_rejects(spark):
    rows = spark.createDataFrame([("a", "Good!"), ("b", ""), ("c", "!!! 123"), ("d", None)], "request_id string, text string")
    accepted, rejected = split_rejects(rows)
    assert [r.request_id for r in accepted.collect()] == ["a"]
    assert sorted(r.request_id for r in rejected.collect()) == ["b", "c", "d"]
    assert "error" in rejected.columns
