"""TF-IDF in long form: one row per document and word."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import ENGLISH_STOPWORDS, FEATURE_WIDTH
from ..sources.storage import stage
from .lookup import BROADCAST_BYTES, HOT_KEYS, lookup

STATISTICS = "word string, documents bigint, occurrences bigint"
#: Words a task counts before it hands on what it has, and bytes of text that it counts at a time.
COUNTED_WORDS, COUNTED_BYTES = 100_000, 8 << 20
_STOPWORDS = frozenset(ENGLISH_STOPWORDS)


def _terms_task(batches: Iterable[pa.RecordBatch], min_chars: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, words, counts = [0], [], []
        for text in batch.column(1).to_pylist():
            terms = _without_stopwords(Counter(_split(text)), min_chars)
            sizes.append(len(terms))
            words += terms.keys()
            counts += terms.values()
        entries = pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "tf"])
        ends = pa.array(np.cumsum(sizes), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, entries)], names)


def _split(text: str | None) -> list[str]:
    return [] if text is None else text.split(" ")


def _without_stopwords(counts: Counter, min_chars: int) -> dict[str, int]:
    return {w: n for w, n in counts.items() if len(w) >= min_chars and w not in _STOPWORDS}


def document_terms(
    df: DataFrame, key: str = "review_id", text: str = "clean_text", min_chars: int = 1
) -> DataFrame:
    """``(key, terms)`` with ``terms`` an array of ``(word, tf)``; one row per input row.

    A document's tokens are already together in its row, so its term frequencies need no shuffle.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, terms array<struct<word:string,tf:bigint>>"
    names = [key, "terms"]
    return df.select(key, text).mapInArrow(lambda batches: _terms_task(batches, min_chars, names), schema)


def term_rows(terms: DataFrame) -> DataFrame:
    """``(key, word, tf)`` from ``document_terms``."""
    return terms.select(*(c for c in terms.columns if c != "terms"), F.inline("terms"))


def word_statistics(df: DataFrame, text: str = "clean_text", min_chars: int = 1) -> DataFrame:
    """``word``, ``documents`` and ``occurrences`` over the texts of ``df``, counted in one pass; the
    row without a word counts the documents.

    Rows of disjoint parts of a corpus add up, so they are a state that merges (see ``add_batch``).
    Each task counts before the shuffle, in a bounded number of words at a time.
    """
    counted = df.select(text).mapInArrow(lambda batches: _statistics_task(batches, min_chars), STATISTICS)
    return _summed(counted)


def _statistics_task(batches: Iterable[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    seen, held = 0, None

    def counted() -> list[pa.RecordBatch]:
        documents = pa.table([[None], [seen], [0]], schema=held.schema)
        return pa.concat_tables([documents, held]).combine_chunks().to_batches()

    for batch in batches:
        for texts in _parts(batch.column(0).drop_null()):
            found = _counted_words(texts, min_chars)
            seen, held = seen + len(texts), found if held is None else _added(held, found)
            if held.num_rows > COUNTED_WORDS:
                yield from counted()
                seen, held = 0, None
    if seen:
        yield from counted()


def _parts(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of ``texts`` of about ``COUNTED_BYTES``, of one text at least."""
    part = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64) // COUNTED_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    return (texts.slice(a, b - a) for a, b in pairwise(cuts) if a < b)


def _counted_words(texts: pa.Array, min_chars: int) -> pa.Table:
    """``word``, ``documents`` and ``occurrences`` of some texts, counted over flat arrays of codes."""
    lists = pc.split_pattern(texts, " ")
    coded = lists.flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy(), coded.dictionary.cast(pa.string())
    sizes = pc.list_value_length(lists).to_numpy()
    pairs = np.repeat(np.arange(len(sizes), dtype=np.int64) << 32, sizes) | codes
    pairs.sort()
    once = pairs[np.diff(pairs, prepend=-1) != 0] & 0xFFFFFFFF
    counts = [np.bincount(c, minlength=len(words)) for c in (once, codes)]
    kept = pc.and_(
        pc.greater_equal(pc.utf8_length(words), min_chars),
        pc.invert(pc.is_in(words, pa.array(ENGLISH_STOPWORDS, pa.string()))),
    )
    return pa.table([words, *counts], ["word", "documents", "occurrences"]).filter(kept)


def _added(*counted: pa.Table) -> pa.Table:
    sums = pa.concat_tables(counted).group_by("word", use_threads=False)
    added = sums.aggregate([("documents", "sum"), ("occurrences", "sum")])
    return added.select(["word", "documents_sum", "occurrences_sum"]).rename_columns(counted[0].column_names)


def _summed(counted: DataFrame) -> DataFrame:
    return counted.groupBy("word").agg(F.sum("documents").alias("documents"), F.sum("occurrences").alias("occurrences"))


def add_batch(df: DataFrame, path: str, batch: str, text: str = "clean_text", min_chars: int = 1) -> None:
    """Count a batch of texts and keep the counts under ``path``. Reading them costs one row for each
    of a batch's distinct words, whatever the batch's size.

    A batch is known by its name: counting it again replaces its counts, so a repeated load does not
    count twice. Batches hold different documents.
    """
    word_statistics(df, text, min_chars).write.mode("overwrite").parquet(f"{path}/batch={batch}")


@dataclass(frozen=True)
class TermStatistics:
    """Corpus statistics of words, counted once and kept in shared storage."""

    words: DataFrame  # word, documents (df), occurrences
    documents: int

    @classmethod
    def of(cls, df: DataFrame, text: str = "clean_text", min_chars: int = 1) -> TermStatistics:
        """The statistics of the texts of ``df``."""
        return cls._kept(word_statistics(df, text, min_chars))

    @classmethod
    def merged(cls, spark: SparkSession, path: str) -> TermStatistics:
        """The statistics of all batches under ``path``; the texts are not read."""
        return cls._kept(_summed(spark.read.schema(STATISTICS).parquet(path)))

    @classmethod
    def of_terms(cls, terms: DataFrame) -> TermStatistics:
        """The statistics of the texts whose ``document_terms`` are given."""
        counted = F.inline(F.array_append("terms", F.struct(F.lit(None).cast("string").alias("word"), F.lit(0).cast("bigint").alias("tf"))))
        rows = terms.select(counted).groupBy("word")
        return cls._kept(rows.agg(F.count(F.lit(1)).alias("documents"), F.sum("tf").alias("occurrences")))

    @classmethod
    def _kept(cls, counted: DataFrame) -> TermStatistics:
        table = stage(counted, "term-statistics")
        marked = table.filter(F.col("word").isNull()).first()
        return cls(table.filter(F.col("word").isNotNull()), marked["documents"] if marked else 0)

    def vocabulary(self, size: int = FEATURE_WIDTH) -> DataFrame:
        """The ``size`` most frequent words, ties by word, with their smoothed idf."""
        idf = F.log(F.lit(1.0 + self.documents) / (F.col("documents") + 1)) + 1
        return (
            self.words.orderBy(F.desc("occurrences"), "word")
            .limit(size)
            .select("word", "occurrences", "documents", idf.alias("idf"))
        )


def tfidf(
    df: DataFrame,
    key: str = "review_id",
    text: str = "clean_text",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_keys: int = HOT_KEYS,
    stats: TermStatistics | None = None,
) -> DataFrame:
    """``(key, word, tf, weight)`` with ``weight = tf * ln((N + 1) / (df + 1))``.

    ``stats`` are the corpus statistics where they are kept already; words they lack are left out.

    One pass over the text, whose terms are kept in shared storage: they are counted there and read
    again to be weighed. While the vocabulary can be broadcast that is once; beyond that twice, as words
    in very many documents are still joined by broadcast and only the rare ones are shuffled.
    """
    terms = stage(document_terms(df.filter(F.col(text).isNotNull()), key, text), "document-terms")
    stats = stats or TermStatistics.of_terms(terms)
    idf = F.log(F.lit(1.0 + stats.documents) / (F.col("documents") + 1))
    joined = lookup(
        term_rows(terms),
        stats.words.select("word", idf.alias("idf")),
        "word",
        counts=stats.words.select("word", F.col("documents").alias("n")),
        broadcast_bytes=broadcast_bytes,
        hot_keys=hot_keys,
    )
    return joined.select(key, "word", "tf", (F.col("tf") * F.col("idf")).alias("weight"))
