"""Near-duplicate embeddings by cross-polytope hashing.

A vector is rotated by random signs and fast Hadamard transforms, three times; the coordinate of
largest magnitude and its sign are its hash. Several such hashes together are the key of a table.
Each vector is put under its own keys and, as probes, under those with the next best coordinate.

Equal vectors of a label are one class. Within a bucket links are confirmed by exact cosines, and only
a spanning forest leaves the task. Links of a vector are then counted within its component, block
against block, so each is counted once and pairs are never listed; see ``groups``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import lookup
from ..sources.storage import stage
from .groups import by_group, components, edge_table, forest, in_blocks, links_within

TABLES = 12
#: Hashes in a key, and keys of a vector in each table: its own, and one for each of its hashes with
#: the next best coordinate, as many as there are.
HASHES = 2
THRESHOLD = 0.98
#: Rows of a bucket or component that are compared in one task at most.
BLOCK_ROWS = 4096
ROWS = 4096
SEED = 7


def rotated(vectors: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Three rounds of random signs and a fast Hadamard transform over rows padded to a power of 2."""
    n, width = vectors.shape[0], signs.shape[1]
    x = np.zeros((n, width))
    x[:, : vectors.shape[1]] = vectors
    for flips in signs:
        x *= flips
        half = 1
        while half < width:
            pairs = x.reshape(n, -1, 2, half)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, width)
            half *= 2
        x /= np.sqrt(width)
    return x


def corners(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and the second nearest corner of the cross-polytope, numbered."""
    size = np.abs(x)
    rows = np.arange(len(x))
    first = size.argmax(1)
    size[rows, first] = -1
    second = size.argmax(1)
    number = lambda at: 2 * at + (x[rows, at] < 0)
    return number(first), number(second)


def keys(vectors: np.ndarray, tables: int = TABLES, hashes: int = HASHES, seed: int = SEED) -> np.ndarray:
    """Keys of each vector, ``tables * (1 + hashes)``; different tables have different keys."""
    width = max(1, 1 << (vectors.shape[1] - 1).bit_length())
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, hashes, 3, width))
    out = []
    for t in range(tables):
        near = [corners(rotated(vectors, signs[t, h])) for h in range(hashes)]
        for probe in range(hashes + 1):
            key = np.full(len(vectors), t, np.int64)
            for h, (first, second) in enumerate(near):
                key = key * (2 * width) + (second if h + 1 == probe else first)
            out.append(key)
    return np.stack(out, 1)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class _Vectors:
    """Vectors of a table of whole groups; those of one group have one length, groups may differ."""

    def __init__(self, column: pa.ChunkedArray):
        lists = column.combine_chunks()
        self.starts = lists.offsets.to_numpy()
        self.flat = lists.values.to_numpy(zero_copy_only=False)

    def of(self, first: int, end: int) -> np.ndarray:
        """Vectors of the rows of a group as a matrix."""
        return self.flat[self.starts[first] : self.starts[end]].reshape(end - first, -1)

    def dots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Inner products of rows ``a`` and ``b``, pair by pair."""
        lengths = self.starts[a + 1] - self.starts[a]
        out = np.empty(len(a))
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            one, other = (self.flat[self.starts[x[at]][:, None] + np.arange(length)] for x in (a, b))
            out[at] = np.einsum("ij,ij->i", one, other)
        return out


def _by_width(batch: pa.RecordBatch, name: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with vectors of one length each."""
    lengths = pc.list_value_length(batch.column(name))
    for length in pc.unique(lengths).to_pylist():
        part = batch.filter(pc.equal(lengths, length))
        for start in range(0, len(part), ROWS):
            yield part.slice(start, ROWS)


def _key_task(batches: Iterable[pa.RecordBatch], tables: int, hashes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _by_width(batch, "unit"):
            made = keys(_matrix(part.column("unit")), tables, hashes)
            flat = pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * made.shape[1], made.ravel())
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), flat], ["id", "label", "keys"])


def _edges(threshold: float):
    def work(table: pa.Table, cuts: np.ndarray) -> pa.Table:
        units, edges = _Vectors(table.column("unit")), []
        two = np.flatnonzero(np.diff(cuts) == 2)
        a, b = cuts[two], cuts[two] + 1
        good = units.dots(a, b) >= threshold
        edges += zip(a[good].tolist(), b[good].tolist())
        for k in np.flatnonzero(np.diff(cuts) > 2):
            first, rows = cuts[k], units.of(cuts[k], cuts[k + 1])

            def linked(i: int, others: np.ndarray, rows=rows) -> np.ndarray:
                return rows[others] @ rows[i] >= threshold

            edges += [(first + i, first + j) for i, j in forest(len(rows), linked)]
        return edge_table(table.column("id").combine_chunks(), edges)

    return work


def _counts(threshold: float):
    def work(table: pa.Table, cuts: np.ndarray) -> pa.Table:
        units = _Vectors(table.column("unit"))
        rows = table.column("rows").to_numpy().astype(np.float64)
        block = table.column("block").to_numpy()
        i, j = table.column("i").to_numpy(), table.column("j").to_numpy()
        links = np.zeros(len(rows))
        for k in range(len(cuts) - 1):
            first, mine = cuts[k], units.of(cuts[k], cuts[k + 1])
            own = np.arange(first, cuts[k + 1])
            one, other = own[block[own] == i[own]], own[block[own] == j[own]]
            for start in range(0, len(one), 1024):
                part = one[start : start + 1024]
                near = (mine[part - first] @ mine[other - first].T >= threshold).astype(np.float64)
                if i[cuts[k]] == j[cuts[k]]:
                    near[part[:, None] == other[None, :]] = 0
                    links[part] += near @ rows[other]
                else:
                    links[part] += near @ rows[other]
                    links[other] += rows[part] @ near
        return pa.table({"id": table.column("id"), "links": pa.array(links.astype(np.int64))})

    return work


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    hashes: int = HASHES,
) -> DataFrame:
    """For each row of ``vectors``: its id, ``n_links`` (other rows linked with it), ``component_id``
    (smallest id reachable over links) and ``kept`` (whether that is its own).

    Rows are compared when their labels are equal and not null, and their vectors have equal lengths.
    They are linked from a cosine of ``threshold`` in double precision on. Vectors that are null,
    empty or zero, or hold a null, NaN or infinity, link with nothing. Rows with one id are rows of
    their own; a null id is larger than all others. Other columns are ignored.
    """
    rows = vectors.select(
        F.col(vec_id).alias("row_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("v")
    )
    largest = F.array_max(F.transform("v", F.abs))
    sound = F.col("label").isNotNull() & F.coalesce(
        ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & (largest > 0), F.lit(False)
    )
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    scaled = F.transform("v", lambda x: x / largest)
    rows = rows.withColumn("scaled", F.when(sound, scaled))
    norm = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda total, x: total + x * x))
    rows = rows.withColumn("norm", norm).select(
        "row_id", "label", F.transform("scaled", lambda x: x / F.col("norm")).alias("unit")
    )
    # Zeros are equal whatever their sign.
    plain = F.transform("unit", lambda x: F.when(x == 0, 0.0).otherwise(x))
    identity = F.md5(F.to_json(F.struct("label", plain.alias("unit"))))
    rows = stage(rows.select("row_id", "label", "unit", F.when(F.col("unit").isNotNull(), identity).alias("id")), "vectors")

    classes = rows.filter("id is not null").groupBy("id").agg(
        F.first("label").alias("label"), F.first("unit").alias("unit"), F.count(F.lit(1)).alias("rows")
    )
    classes = stage(classes, "vector-classes")

    def key_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _key_task(batches, tables, hashes)

    kind = classes.schema["label"].dataType.simpleString()
    keyed = classes.select("id", "label", "unit").mapInArrow(key_task, f"id string, label {kind}, keys array<bigint>")
    held = keyed.select("id", "label", F.explode(F.array_distinct("keys")).alias("key"))
    members = held.select("id", F.xxhash64("label", "key").alias("g"))

    def with_vectors(rows: DataFrame) -> DataFrame:
        # Rows of one group have one length of vectors and one label, whatever keys collide.
        full = rows.join(classes.select("id", "unit", "label"), "id")
        return full.withColumn("g", F.xxhash64("g", "label", F.size("unit"))).drop("label")

    edges = links_within(members, F.lit(1), BLOCK_ROWS, _edges(threshold), with_vectors)
    found = components(edges).withColumnRenamed("node", "id")

    together = classes.join(found, "id").withColumn("g", F.xxhash64("root"))
    blocks = in_blocks(together, F.lit(1), BLOCK_ROWS // 2)
    counted = by_group(blocks.select("g", "i", "j", "block", "id", "unit", "rows"), _counts(threshold), "id string, links bigint")
    links = counted.groupBy("id").agg(F.sum("links").alias("links"))
    known = classes.select("id", "rows").join(found, "id", "left").join(links, "id", "left")
    known = stage(known.select("id", F.coalesce("root", "id").alias("root"), (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("n")), "vector-links")

    rooted = stage(lookup(rows.select("row_id", "id"), known, "id", "left"), "vector-roots")
    least = rooted.filter("root is not null").groupBy("root").agg(F.min("row_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    named = lookup(rooted, least.filter("rows > 1").select("root", "least"), "root", "left")
    component = F.coalesce("least", "row_id")
    return named.select(
        F.col("row_id").alias(vec_id),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("row_id")).alias("kept"),
    )
