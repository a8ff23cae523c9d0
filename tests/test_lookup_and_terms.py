import math
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sentiflow.functions.fixed_values import ENGLISH_STOPWORDS
from sentiflow.operators import (
    document_terms,
    keyword_counts,
    keywords,
    lookup,
    term_rows,
    tfidf,
    top_words,
    vocab_tfidf,
    word_counts,
)
from sentiflow.operators.terms import TermStatistics

from .conftest import optimized, plan_of


@pytest.fixture(scope="module")
def skewed_rows(spark):
    """A third of the rows share one key, some keys are unknown."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
    return spark.range(30_000).select(key.alias("k"), "id")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_keys", [2, 50, 100_000])
def test_lookup_beyond_the_broadcast_size(spark, skewed_rows, how, hot_keys):
    table = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    small = lookup(skewed_rows, table, "k", how)
    large = lookup(skewed_rows, table, "k", how, broadcast_bytes=0, hot_keys=hot_keys)
    expected = skewed_rows.join(table, "k", how)
    for got in (small, large):
        assert got.count() == expected.count()
        assert got.exceptAll(expected.select(*got.columns)).count() == 0


def test_lookup_broadcasts_only_hot_keys(spark, skewed_rows):
    table = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    counts = skewed_rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    plan = optimized(lookup(skewed_rows, table, "k", counts=counts, broadcast_bytes=0, hot_keys=50))
    assert "Union" in plan and "Cartesian" not in plan and "Join Cross" not in plan


@pytest.fixture(scope="module")
def small(spark):
    texts = ["great great phone", "bad phone", "the the", "a battery lasts long battery", "great day"]
    return spark.createDataFrame([(i, t, float(i % 3)) for i, t in enumerate(texts)], "review_id bigint, clean_text string, label double")


def words_of(text):
    return [w for w in text.split(" ") if w not in ENGLISH_STOPWORDS]


def test_document_terms(small):
    got = {(r.review_id, r.word): r.tf for r in term_rows(document_terms(small)).collect()}
    expected = {
        (r.review_id, w): n for r in small.collect() for w, n in Counter(words_of(r.clean_text)).items()
    }
    assert got == expected
    assert "Exchange" not in plan_of(document_terms(small))


def test_documents_without_terms_count(small):
    stats = TermStatistics.of(small)
    assert stats.documents == 5
    assert {r.word: (r.documents, r.occurrences) for r in stats.words.collect()}["great"] == (2, 3)


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "hot_keys": 5}, {"broadcast_bytes": 0, "hot_keys": 1000}])
def test_tfidf(small, options):
    docs = [words_of(r.clean_text) for r in small.orderBy("review_id").collect()]
    df = Counter(w for d in docs for w in set(d))
    expected = {
        (i, w): n * math.log((len(docs) + 1) / (df[w] + 1)) for i, d in enumerate(docs) for w, n in Counter(d).items()
    }
    rows = tfidf(small, **options).collect()
    assert len(rows) == len(expected)
    for r in rows:
        assert r.weight == pytest.approx(expected[r.review_id, r.word], abs=1e-12)


def test_vocab_tfidf(small):
    rows = vocab_tfidf(small, size=3).collect()
    assert {r.word for r in rows} == {"great", "battery", "phone"}  # counts 3, 2, 2
    for key in {r.review_id for r in rows}:
        assert sum(r.weight**2 for r in rows if r.review_id == key) == pytest.approx(1)


def test_vocab_tfidf_of_documents_that_share_a_key(spark):
    rows = spark.createDataFrame([(1, "great phone"), (1, "great phone"), (1, "")], "review_id int, clean_text string")
    weights = [r.weight for r in vocab_tfidf(rows).collect()]
    assert weights == pytest.approx([0.5**0.5] * 4)


def test_word_counts_and_ranks(small):
    counts = {(r.label, r.word): r["count"] for r in word_counts(small).collect()}
    assert counts[0.0, "great"] == 2 and (2.0, "the") not in counts
    top = top_words(small, 1, stop_sets=("custom", "canonical")).collect()
    assert {r.label: r.word for r in top} == {0.0: "great", 1.0: "bad"}


def test_top_words_are_limited_before_the_shuffle(cleaned):
    plan = plan_of(top_words(cleaned))
    assert plan.count("WindowGroupLimit") == 2


def test_keywords(spark, small):
    lexicon = spark.createDataFrame(
        [("great", "great", "ADJ"), ("lasts", "last", "VERB"), ("long", "long", "ADJ"), ("battery", "battery", "NOUN"), ("phone", "phone", "NOUN")],
        "form string, lemma string, pos string",
    )
    counts = {(r.label, r.word): r["count"] for r in keyword_counts(small, lexicon).collect()}
    assert counts == {(0.0, "great"): 2, (0.0, "long"): 1, (1.0, "great"): 1}
    custom = keyword_counts(small, lexicon, stop_sets=("custom",))
    assert {r.word for r in custom.collect()} == {"great", "long", "battery"}
    unknown = keyword_counts(small, lexicon, keep_unknown=True)
    assert {r.word for r in unknown.collect()} == {"great", "long", "bad"}
    expected = [(0, 0, "great"), (0, 1, "great"), (3, 3, "long"), (4, 0, "great")]
    for options in ({}, {"broadcast_bytes": 0, "hot_keys": 3}):
        rows = keywords(small, lexicon, **options).collect()
        assert sorted(tuple(r) for r in rows) == expected


def test_weights_clean_and_count_texts_once(small):
    """What is joined are the kept terms: neither way reads the texts again."""
    for options in ({}, {"broadcast_bytes": 0, "hot_keys": 5}):
        files = tfidf(small, **options).inputFiles()
        assert files and all("/document-terms-" in f or "/term-statistics-" in f for f in files)


def test_term_statistics_count_null_words_and_texts(spark, monkeypatch):
    from sentiflow.operators import terms

    texts = [("great a the", 1), ("", 2), (None, 3), ("great  great b", 4)]
    df = spark.createDataFrame(texts, "clean_text string, review_id int").repartition(2)
    expected = {None: (3, 0), "great": (2, 3), "b": (1, 1)}
    for limit in (100_000, 0):
        monkeypatch.setattr(terms, "COUNTED_WORDS", limit)
        counted = terms.word_statistics(df, min_chars=1).collect()
        assert {r.word: (r.documents, r.occurrences) for r in counted if r.word != ""} == expected
    kept = TermStatistics.of_terms(document_terms(df.filter("clean_text is not null")))
    assert kept.documents == 3
    assert {r.word: (r.documents, r.occurrences) for r in kept.words.collect() if r.word} == {"great": (2, 3), "b": (1, 1)}


def test_keywords_join_only_the_lexicons_keywords(spark, small, monkeypatch):
    module = sys.modules["sentiflow.operators.keywords"]
    joined, look = [], module.lookup
    monkeypatch.setattr(module, "lookup", lambda rows, table, *a, **b: joined.append(table) or look(rows, table, *a, **b))
    lexicon = spark.createDataFrame([("great", "great", "ADJ"), ("lasts", "last", "VERB")], "form string, lemma string, pos string")
    assert keywords(small, lexicon).count() == 3
    assert [tuple(r) for r in joined[0].collect()] == [("great", "great")]
