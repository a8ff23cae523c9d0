"""Keywords: adjectives and nouns by lemma, without stop words.

Word class and lemma come from a lexicon table ``(form, lemma, pos)`` with one row per form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import ENGLISH_STOPWORDS, KEYWORD_POS, MIN_KEYWORD_LENGTH, TOP_WORDS
from ..functions.text import tokens
from .lookup import BROADCAST_BYTES, HOT_KEYS, lookup
from .summary import domain_words, rank_words, token_rows

STOP_SETS = ("custom", "canonical")


def _select_keywords(tagged: DataFrame, stop_sets: tuple[str, ...], keep_unknown: bool) -> DataFrame:
    """Keep ADJ/NOUN rows whose lemma is in no domain list, as column ``word``."""
    wanted = F.col("pos").isin(*KEYWORD_POS)
    if keep_unknown:
        wanted = wanted | F.col("pos").isNull()
    rows = tagged.filter(wanted).withColumn("word", F.lower(F.coalesce("lemma", "form")))
    stop = domain_words(stop_sets)
    return rows.filter(~F.col("word").isin(*stop)) if stop else rows


def keyword_counts(
    df: DataFrame,
    lexicon: DataFrame,
    stop_sets: tuple[str, ...] = STOP_SETS,
    keep_unknown: bool = False,
    text: str = "clean_text",
) -> DataFrame:
    """``(label, word, count)`` of keywords.

    Tokens are counted per class and form before the lexicon is joined. The join then sees each form
    at most once per class, so it has no hot keys and its size is the vocabulary's, not the corpus'.
    """
    forms = token_rows(df, text).groupBy("label", "form").agg(F.count(F.lit(1)).alias("n"))
    tagged = forms.join(lexicon.select("form", "lemma", "pos"), "form", "left" if keep_unknown else "inner")
    return (
        _select_keywords(tagged, stop_sets, keep_unknown)
        .groupBy("label", "word")
        .agg(F.sum("n").alias("count"))
    )


def keywords_top(
    df: DataFrame,
    lexicon: DataFrame,
    n: int = TOP_WORDS,
    stop_sets: tuple[str, ...] = STOP_SETS,
    keep_unknown: bool = False,
) -> DataFrame:
    return rank_words(keyword_counts(df, lexicon, stop_sets, keep_unknown), n)


def keywords(
    df: DataFrame,
    lexicon: DataFrame,
    stop_sets: tuple[str, ...] = STOP_SETS,
    keep_unknown: bool = False,
    key: str = "review_id",
    text: str = "clean_text",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """``(key, position, word)``: each document's keywords with their token position."""
    positions = df.select(key, F.posexplode(tokens(text)).alias("position", "form")).filter(
        (F.length("form") > MIN_KEYWORD_LENGTH) & ~F.col("form").isin(*ENGLISH_STOPWORDS)
    )
    sizes = {"broadcast_bytes": broadcast_bytes, "hot_keys": hot_keys}
    if not keep_unknown:
        # Keywords are told by the lexicon alone: what is joined, and shuffled if need be, are only these.
        words = _select_keywords(lexicon.select("form", "lemma", "pos"), stop_sets, False).select("form", "word")
        return lookup(positions, words, "form", **sizes).select(key, "position", "word")
    tagged = lookup(positions, lexicon.select("form", "lemma", "pos"), "form", "left", **sizes)
    return _select_keywords(tagged, stop_sets, True).select(key, "position", "word")
