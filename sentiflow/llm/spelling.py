"""Spelling variants of words by PartEnum signatures.

Two words one edit apart (a code point inserted, deleted or replaced) have letter multisets that
differ in two elements at most. A multiset is a binary vector over (letter, occurrence) dimensions,
so near words have a Hamming distance of at most two:

1. The dimensions are dealt to ``PARTS`` partitions. Two differences touch two partitions at most, so
   near words agree on all others: for every two partitions left out, the hash of the rest is a
   signature, and near words share one of them at least.
2. Words are joined on signatures and each pair is verified by its edit distance. Signatures that
   many words share get longer keys first, which keep every near pair (``halves``).
3. A word's form is its most frequent near word, where that is frequent enough; forms of forms are
   followed by pointer jumping.

All is built from DataFrame functions. What grows with the corpus is counted per task before the
shuffle; from there on everything grows with the number of distinct words.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import with_computed
from ..operators.lookup import lookup
from ..sources.storage import stage
from .common import ascii_lower, text_or_empty

#: Runs of letters in text whose A-Z are in lower case.
LETTERS = r"[a-zÀ-ÿ]+"
PARTS = 6
#: Words of a signature from which on its keys are made longer.
BUCKET_WORDS = 128


def letter_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``run``: every maximal run of letters of every text, A-Z in lower case."""
    runs = F.regexp_extract_all(ascii_lower(text_or_empty(text)), F.lit(LETTERS), F.lit(0))
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(runs).alias("run"))


def with_signatures(words: DataFrame) -> DataFrame:
    """``words`` with ``signatures``: one hash for each two partitions of the (letter, occurrence)
    dimensions that are left out."""
    letter = F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.substr("word", i, F.lit(1)))
    dimension = F.transform("letters", lambda c, i: F.xxhash64(c, i - F.array_position("letters", c)))

    def part(p: int) -> Column:
        dealt = F.filter("dimensions", lambda d: F.pmod(d, F.lit(PARTS)) == p)
        return F.aggregate(dealt, F.lit(0).cast("bigint"), lambda x, d: x.bitwiseXOR(d))

    def without(n: int, pair: tuple[int, int]) -> Column:
        return F.xxhash64(F.lit(n), *(F.col("parts")[p] for p in range(PARTS) if p not in pair))

    made = with_computed(words, "letters", F.array_sort(letter))
    made = with_computed(made, "dimensions", dimension)
    made = with_computed(made, "parts", F.array(*(part(p) for p in range(PARTS))))
    signatures = F.array(*(without(n, pair) for n, pair in enumerate(combinations(range(PARTS), 2))))
    return made.withColumn("signatures", signatures).drop("letters", "dimensions", "parts")


def halves(word: Column) -> Column:
    """Keys of which words one edit apart share one, whatever the edit.

    Let ``n`` be the length of the shorter word: they agree in their first ``n // 2`` code points or
    in their last ``n - n // 2``. A word is taken as the shorter and as the longer one.
    """
    size = F.length(word)

    def cut(shorter: Column) -> list[Column]:
        half = F.floor(shorter / 2).cast("int")
        front = F.xxhash64(F.lit("front"), shorter, F.substr(word, F.lit(1), half))
        back = F.xxhash64(F.lit("back"), shorter, F.substr(word, size - (shorter - half) + 1, shorter - half))
        return [front, back]

    return F.array(*cut(size), *cut(size - 1))


def near_pairs(words: DataFrame, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """``a``, ``b``, ``a_n``, ``b_n``: all pairs ``a < b`` of ``words`` (``word``, ``n``; distinct,
    two code points at least) that are one edit apart, each once."""
    keyed = with_signatures(words.select("word", "n"))
    keyed = stage(keyed.select("word", "n", F.explode("signatures").alias("key")), "signatures")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("words")).filter("words > 1")
    shared = keyed.join(sizes, "key")
    longer = F.transform(halves(F.col("word")), lambda half: F.xxhash64("key", half))
    keys = F.when(F.col("words") > bucket_words, F.array_distinct(longer)).otherwise(F.array("key"))
    members = stage(shared.select("word", "n", F.explode(keys).alias("key")), "signature-members")
    a = members.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = members.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    near = (F.col("a") < F.col("b")) & (F.levenshtein("a", "b", 1) == 1)
    return a.join(b, "key").filter(near).select("a", "b", "a_n", "b_n").distinct()


def followed(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of ``forms`` (``word``, ``form``): the last form of the word's forms.

    Forms are much more frequent than their words, so chains end and are short; each round doubles
    the steps taken.
    """
    hops = stage(forms.select("word", F.col("form").alias("root")), "hops")
    while True:
        over = hops.select(F.col("word").alias("root"), F.col("root").alias("top"))
        jumped = lookup(hops, over, "root", "left").select(
            "word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")
        )
        moved = stage(jumped, "hops")
        hops = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return hops


def variants(
    occurrences: DataFrame,
    word: str = "word",
    min_chars: int = 6,
    min_count: int = 5,
    ratio: int = 5,
    bucket_words: int = BUCKET_WORDS,
) -> DataFrame:
    """For each word of ``min_chars`` code points that occurs ``min_count`` times: ``n``, ``n_near``
    (words one edit away), ``form`` and ``form_n`` (the near word of largest ``n``, the smallest in
    code-point order among equals, if it is ``ratio`` times as frequent as the word; else null) and
    ``root``, the last of the forms that follow (the word itself if it has none).

    ``occurrences`` has one row per occurrence; null words do not count, other columns are ignored.
    Without words the result is empty. Words may be of any length; ``min_chars`` is two at least, and
    ``ratio`` is too, so that chains of forms end.
    """
    if min_chars < 2 or ratio < 2:
        raise ValueError("min_chars and ratio are 2 at least")
    counted = occurrences.select(F.col(word).alias("word")).filter(F.length("word") >= min_chars)
    counted = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = stage(counted.filter(F.col("n") >= min_count), "spelled-words")
    ends = F.inline(
        F.array(
            F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
            F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
        )
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_pairs(words, bucket_words).select(ends).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    fits = -F.col("best.less") >= ratio * F.col("n")
    found = near.select(
        "word", "n_near", F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")
    )
    found = stage(found, "near-words")
    roots = followed(found.filter("form is not null").select("word", "form"))
    return words.join(found, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n"
    )
