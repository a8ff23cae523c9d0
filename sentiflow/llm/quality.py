"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are three-byte shapes (letters by case, digits, marks by themselves) and how much of it
repeats. Their weights are projected onto the leading singular vectors of a bounded sample of labelled
texts. Every document is compared with the whole sample by exact cosine, a block of documents at a
time, and the labels of its nearest neighbours vote, weighted by similarity.

The sample is bounded by a parameter, so the model that is broadcast is too: at most
``2 * per_class`` vectors of ``dimensions`` numbers and a projection of fixed size.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled texts of each class that the model is fitted on, at most.
PER_CLASS = 1000
DIMENSIONS = 16
NEIGHBOURS = 9
#: Similarities are raised to this power before they weigh labels.
SHARPNESS = 4
THRESHOLD = 0.3
BLOCK = 512

#: Hashed shapes, and steps of the two repetition measures: shares of 1, 1/2, ... 1/128.
SHAPES = 2048
STEPS = 8
TERMS = SHAPES + 2 * STEPS


def _byte_classes() -> np.ndarray:
    kinds = {}
    for b in range(256):
        c = chr(b)
        if b >= 128:
            kind = "beyond ASCII"
        elif c.isalpha():
            kind = "upper" if c.isupper() else "lower"
        elif c.isdigit():
            kind = "digit"
        elif c != "\n" and c.isspace():
            kind = "space"
        elif b < 32 or b == 127:
            kind = "line" if c == "\n" else "control"
        else:
            kind = c
        kinds[b] = kind
    number = {kind: i for i, kind in enumerate(dict.fromkeys(kinds.values()))}
    return np.array([number[kinds[b]] for b in range(256)], np.int64)


CLASSES = _byte_classes()


def term_counts(text: str | None) -> np.ndarray:
    """How often each term occurs. Null, empty and one- or two-byte texts have no shapes."""
    out = np.zeros(TERMS, np.float32)
    if not text:
        return out
    shape = CLASSES[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    kinds = int(CLASSES.max()) + 1
    shapes = (shape[:-2] * kinds + shape[1:-1]) * kinds + shape[2:]
    out[:SHAPES] = np.bincount((shapes * 0x9E3779B1 & 0xFFFFFFFF) >> 21, minlength=SHAPES)
    words = text.split()
    if words:
        again = sum(map(operator.eq, words, words[1:])) / max(1, len(words) - 1)
        seen = 1 - len(set(words)) / len(words)
        steps = 0.5 ** np.arange(STEPS)
        out[SHAPES:] = np.r_[again >= steps, seen >= steps] * max(1, len(shapes))
    return out


def _weights(counts: np.ndarray) -> np.ndarray:
    return np.log1p(counts) / np.log1p(np.maximum(1, counts[:, :SHAPES].sum(1, keepdims=True)))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    """``projection`` from weighted terms to the latent space, the sample's vectors and labels."""

    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int = NEIGHBOURS

    def vectorise(self, texts) -> np.ndarray:
        counts = np.stack([term_counts(text) for text in texts])
        return _unit(_weights(counts).astype(np.float64) @ self.projection)

    def score(self, texts) -> np.ndarray:
        """Share of label 1 among the neighbours' votes; without any vote, 0.5."""
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        # Cosines in steps of 2**-40, far above the error of the products: equal neighbours are equal
        # whatever block they are computed in, and the one fitted first comes first.
        steps = np.rint(self.vectorise(texts) @ self.vectors.T * 2.0**40).astype(np.int64)
        n = min(self.neighbours, len(self.labels))
        place = steps * len(self.labels) - np.arange(len(self.labels))
        nearest = np.sort(np.argpartition(-place, n - 1, axis=1)[:, :n], axis=1)
        votes = np.maximum(np.take_along_axis(steps, nearest, 1) / 2.0**40, 0) ** SHARPNESS
        total = votes.sum(1)
        return np.where(total > 0, (votes * self.labels[nearest]).sum(1) / np.maximum(total, 1e-300), 0.5)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = PER_CLASS,
    dimensions: int = DIMENSIONS,
    neighbours: int = NEIGHBOURS,
) -> Model:
    """Fit on ``labels`` (``doc_id``, ``quality`` 0 or 1) of ``docs`` (``doc_id``, ``text``).

    Of each class, the ``per_class`` labelled documents with the smallest hashes are used, as many of
    either class as the rarer one has where it has any. Labels that are neither 0 nor 1 and rows
    without ``doc_id`` are ignored; of contradicting labels of a document 0 holds; of several texts
    with one ``doc_id`` the largest is used. Without labelled texts every score is 0.5.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    place = F.xxhash64(F.col("doc_id").cast("string"))
    drawn = None
    for label in (0, 1):
        one = known.filter(F.col("quality") == label).orderBy(place, "doc_id").limit(per_class)
        drawn = one if drawn is None else drawn.unionByName(one)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), "doc_id")
    texts = texts.groupBy("doc_id", "quality").agg(F.max("text").alias("text"))
    counts = F.pandas_udf(lambda s: pd.Series([term_counts(t).tobytes() for t in s]), "binary")
    rows = texts.select("quality", "doc_id", counts("text").alias("counts")).orderBy("quality", "doc_id").collect()
    y = np.array([r["quality"] for r in rows], np.float64)
    x = _weights(np.array([np.frombuffer(r["counts"], np.float32) for r in rows]).reshape(-1, TERMS))
    fewest = min(filter(None, (int((y == 0).sum()), int((y == 1).sum()))), default=0)
    kept = np.concatenate([np.flatnonzero(y == label)[:fewest] for label in (0, 1)]).astype(int)
    x, y = x[kept], y[kept]
    if not len(y):
        return Model(np.zeros((TERMS, 1)), np.zeros((0, 1)), y, neighbours)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 0.1
    weighted = _unit(x * idf).astype(np.float64)
    values, left = np.linalg.eigh(weighted @ weighted.T)  # singular vectors of the sample
    lead = np.argsort(-values)[:dimensions]
    lead = lead[values[lead] > 1e-9]
    latent = weighted.T @ left[:, lead] / np.sqrt(values[lead])
    projection = idf[:, None] * latent
    return Model(projection, _unit(x.astype(np.float64) @ projection), y, neighbours)


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The score of each text, from 0 to 1; ``docs`` only gives the session.

    Texts without terms, null and empty ones among them, have no neighbours and score 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            blocks = [shared.value.score(texts.iloc[i : i + BLOCK]) for i in range(0, len(texts), BLOCK)]
            yield pd.Series(np.concatenate(blocks) if blocks else np.empty(0))

    return F.pandas_udf(scores, "double")(F.col(text).cast("string"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose labels are never learned from. A null ``doc_id`` is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **settings) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of each row of ``docs``, by a model
    fitted on the labels that are not held out."""
    model = fit(docs, labels.filter(~held_out()), **settings)
    scored = docs.select("doc_id", held_out().alias("held_out"), score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **settings) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    model = fit(docs, labels.filter(~held_out()), **settings)
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    return rows.filter(score(docs, model) >= threshold).select("row.*")
