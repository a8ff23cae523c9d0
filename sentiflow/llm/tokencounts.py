"""Token counts without token ids.

A text is cut into pre-tokens that no merge of the tokenizer crosses: its words, each with the spaces
in front of it, and its line breaks. The tokens of a text are then the sum over its distinct
pre-tokens of frequency times pieces, and a pre-token's pieces are counted once for the whole corpus:

1. Every task counts the pre-tokens of its texts and reports the frequent ones: those with at least a
   ``FREQUENT``-th of what it has counted, longer ones with more in proportion. A pre-token with that
   share of the corpus has it in some report. As shares add up to 1, pre-tokens with that share of the
   corpus as reported are ``FREQUENT`` at most, and have ``FREQUENT * SHORT`` characters at most
   together; their pieces are counted once and broadcast.
2. Every document's frequencies are formed in its row. Frequent pre-tokens are joined to their pieces
   there; what is left, the rare ones, is kept in the row.
3. Rare pre-tokens are dealt out by their text, so that equal ones meet in one task, which counts the
   pieces once and joins them to all documents' frequencies. Their sums by document are added up.

No ids leave a tokenizer call.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import stage

MARK = "▁"
#: A pre-token that is one in so many is frequent; one longer than ``SHORT`` characters has to be the
#: more frequent by as much.
FREQUENT = 2_000_000
SHORT = 16
#: Distinct pre-tokens that a task holds before it reports or forgets them, and texts (in bytes) and
#: pre-tokens it handles at once.
HELD = 1_000_000
SLICE_BYTES = 4_000_000
CALL_WORDS = 20_000

PRE_TOKEN = re.compile(r" *[^ \n]+| +")


def pre_tokens(text: str) -> list[str]:
    """Words with the spaces before them, and runs of spaces that no word follows; without line
    breaks. A text starts with the space that the tokenizer puts there."""
    return PRE_TOKEN.findall(" " + text.replace(MARK, " ")) if text else []


class PieceCounter:
    """Counts pieces of pre-tokens with a SentencePiece model."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=model)

    def check(self) -> None:
        """Refuse models whose merges could cross a cut, or that change the text before."""
        sp = self.model
        pieces = [
            sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))
        ]
        crossing = [p for p in pieces if "\n" in p or MARK in p.lstrip(MARK)]
        plain = sp.normalize("ﬁ  a \n b ") == f"{MARK}ﬁ{MARK}{MARK}a{MARK}\n{MARK}b{MARK}"
        if crossing or not plain or sp.encode("\n", out_type=str) != [MARK, "<0x0A>"]:
            raise ValueError("merges of this model may cross words, or it changes white space")

    def __call__(self, words: list[str]) -> np.ndarray:
        """Pieces of each pre-token. Behind a line break no space is put in front of it, and the
        break itself has two pieces with the space in front of that."""
        counts = [np.empty(0, np.int64)]
        for start in range(0, len(words), CALL_WORDS):
            encoded = self.model.encode(["\n" + w for w in words[start : start + CALL_WORDS]], num_threads=1)
            counts.append(np.fromiter(map(len, encoded), np.int64, len(encoded)) - 2)
        return np.concatenate(counts)


def _slices(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts have about ``SLICE_BYTES`` together, one row at least."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size)
        start = 0
        while start < len(batch):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] - size[start] + SLICE_BYTES, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _reports(batches: Iterable[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """``word`` and ``n`` of the frequent pre-tokens among what has been counted; a null word for all
    that has been."""
    held: Counter[str] = Counter()

    def report() -> pa.RecordBatch:
        total = held.total()
        kept = [(w, n) for w, n in held.items() if n * share * SHORT >= total * max(SHORT, len(w))]
        words = [None, *(w for w, _ in kept)]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([total, *(n for _, n in kept)], pa.int64())], ["word", "n"])

    for part in _slices(batches):
        for text in part.column("text").to_pylist():
            if text:
                held.update(pre_tokens(text))
        if len(held) > HELD:
            yield report()
            held.clear()
    if held:
        yield report()


def _document_rows(batches: Iterable[pa.RecordBatch], known: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """Tokens of frequent pre-tokens and line breaks, and the rare pre-tokens with their
    frequencies."""
    for part in _slices(batches):
        texts = part.column("text").to_pylist()
        counted, words, times, ends = [], [], [], [0]
        for text in texts:
            tokens = text.count("\n") if text else 0
            for word, n in Counter(pre_tokens(text)).items() if text else ():
                pieces = known.get(word)
                if pieces is None:
                    words.append(word)
                    times.append(n)
                else:
                    tokens += pieces * n
            counted.append(tokens)
            ends.append(len(words))
        size = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
        offsets = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                part.column("key"),
                size,
                pa.array(counted, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(words, pa.string())),
                pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
            ],
            ["key", "n_bytes", "counted", "words", "times"],
        )


def _rare_tokens(batches: Iterable[pa.RecordBatch], count: PieceCounter) -> Iterator[pa.RecordBatch]:
    """Tokens that each rare pre-token adds to a document; those of a task are counted once each."""
    pieces: dict[str, int] = {}
    for batch in batches:
        if not len(batch):
            continue
        coded = batch.column("word").dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(pieces) > HELD:
            pieces.clear()
        new = [w for w in words if w not in pieces]
        pieces.update(zip(new, count(new).tolist()))
        each = np.fromiter(map(pieces.__getitem__, words), np.int64, len(words))
        tokens = each[coded.indices.to_numpy()] * batch.column("n").to_numpy()
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(tokens)], ["row", "tokens"])


def count_tokens(
    docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """``key``, ``n_bytes`` (of the text in UTF-8) and ``n_tokens`` for each row of ``docs``.

    Tokens are those the SentencePiece library gives for the text, without begin and end. Null and
    empty texts have none. Rows are independent of one another, so repeated and null keys stay as they
    are; other columns are ignored. ``model`` is the path of the model's file on all executors; models
    whose merges could cross words are refused. A pre-token longer than memory's share of a task
    fails, as the text that holds it would.
    """
    PieceCounter(model).check()
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))

    def report_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _reports(batches, frequent)

    def count_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = PieceCounter(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(count(batch.column("word").to_pylist()))], ["word", "pieces"])

    reported = rows.select("text").mapInArrow(report_task, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    reported = stage(reported, "frequent-pre-tokens")
    total = (reported.filter("word is null").first() or [None, 0])[1]
    least = F.greatest(F.length("word") / SHORT, F.lit(1.0)) * total / frequent
    chosen = reported.filter(F.col("word").isNotNull() & (F.col("n") >= least)).select("word")
    # Bounded, see above.
    known = {r["word"]: r["pieces"] for r in chosen.mapInArrow(count_task, "word string, pieces bigint").toLocalIterator()}
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def document_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _document_rows(batches, shared.value)

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_bytes bigint, counted bigint, words array<string>, times array<int>"
    # Numbers of rows are given once, when the table is written.
    counted = rows.mapInArrow(document_task, schema).withColumn("row", F.monotonically_increasing_id())
    counted = stage(counted, "pre-token-frequencies")

    def rare_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _rare_tokens(batches, PieceCounter(model))

    pairs = counted.select("row", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("n"))))
    rare = pairs.repartition("word").mapInArrow(rare_task, "row bigint, tokens bigint")
    sums = rare.groupBy("row").agg(F.sum("tokens").alias("tokens"))
    return counted.select("row", "key", "n_bytes", "counted").join(sums, "row", "left").select(
        F.col("key").alias(key), "n_bytes", (F.col("counted") + F.coalesce("tokens", F.lit(0))).alias("n_tokens")
    )
