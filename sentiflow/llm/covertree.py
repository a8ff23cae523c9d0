"""Hard negatives by cover trees over norm-augmented vectors.

The rows are cut into blocks and each block gets a cover tree. A vector gets one more component, so
that all of a block have the norm of its longest one; the nearer it then is to a query, the larger its
inner product. A node of the tree holds the rows within its covering radius of its centre, and the
radius bounds their products from both sides. Its children are centres far from each other, found
farthest first, with the rows nearest to them.

A search descends best bound first. It leaves out nodes whose bounds lie outside all windows, or below
what has been found for them, and computes exact products of what is left. Rows are searched for in
all blocks, each block by all queries; only the first few of each block are kept and ranked.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.lookup import lookup
from ..sources.storage import stage
from .groups import by_group

#: Rows of a leaf, and children of a node at most.
LEAF = 512
CHILDREN = 16
#: A child's rows are within this share of its parent's radius, if its children are enough.
SHRINK = 0.6
#: Bytes of a block's vectors, queries that meet a block in one task, those whose bounds are computed
#: together, and groups that labels are dealt to.
BLOCK_BYTES = 8_000_000
QUERIES = 4096
AT_ONCE = 256
LABEL_GROUPS = 64
#: Products up to here are exact in double precision.
EXACT = 2.0**52


class CoverTree:
    """Rows in the order of the tree, and its nodes: each has a centre row, a covering radius, the
    rows from ``start`` to ``end``, and children that stand one behind the other."""

    NAMES = ("rows", "ids", "keys", "labels", "norm", "centre", "radius", "start", "end", "first", "children")

    def __init__(self, **parts: np.ndarray):
        self.__dict__.update(parts)

    @classmethod
    def build(cls, vectors: np.ndarray, ids: np.ndarray, keys: np.ndarray, labels: np.ndarray) -> CoverTree:
        squares = np.einsum("ij,ij->i", vectors, vectors)
        longest = squares.max()
        points = np.c_[vectors, np.sqrt(longest - squares)]
        order = np.arange(len(points))
        nodes: list[list] = []  # centre, radius, start, end, first child, children

        def add(centre: int, start: int, end: int) -> None:
            radius = np.linalg.norm(points[order[start:end]] - points[centre], axis=1).max()
            nodes.append([centre, radius, start, end, 0, 0])

        add(0, 0, len(points))
        at = 0
        while at < len(nodes):
            centre, radius, start, end, _, _ = nodes[at]
            if end - start > LEAF and radius > 0:
                rows = order[start:end].copy()
                nearest = np.linalg.norm(points[rows] - points[centre], axis=1)
                owner, centres = np.zeros(len(rows), np.int64), [centre]
                while len(centres) < CHILDREN and nearest.max() > radius * SHRINK or len(centres) < 2:
                    far = int(rows[nearest.argmax()])
                    distance = np.linalg.norm(points[rows] - points[far], axis=1)
                    closer = distance < nearest
                    nearest[closer], owner[closer] = distance[closer], len(centres)
                    centres.append(far)
                order[start:end] = rows[np.argsort(owner, kind="stable")]
                sizes = np.bincount(owner, minlength=len(centres))
                ends = start + np.cumsum(sizes)
                nodes[at][4:] = [len(nodes), int((sizes > 0).sum())]
                for child, size, last in zip(centres, sizes, ends):
                    if size:
                        add(child, last - size, last)
            at += 1
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        columns = list(zip(*nodes))
        return cls(
            rows=vectors[order], ids=ids[order], keys=keys[order], labels=labels[order], norm=np.array(longest),
            centre=place[np.array(columns[0])], radius=np.array(columns[1]), start=np.array(columns[2]),
            end=np.array(columns[3]), first=np.array(columns[4]), children=np.array(columns[5]),
        )

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.NAMES})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> CoverTree:
        with np.load(io.BytesIO(data)) as parts:
            return cls(**{name: parts[name] for name in cls.NAMES})

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Between which the products of each node's rows with each query lie, a little more for
        rounding."""
        squares = np.einsum("ij,ij->i", queries, queries)[:, None]
        products, total = queries @ self.rows[self.centre].T, squares + self.norm
        distance = np.sqrt(np.maximum(total - 2 * products, 0))
        slack, reach = 0.25 + 1e-9 * total, np.sqrt(squares) * self.radius
        high = np.minimum((total - np.maximum(distance - self.radius, 0) ** 2) / 2, products + reach)
        low = np.maximum((total - (distance + self.radius) ** 2) / 2, products - reach)
        return low - slack, high + slack

    def search(
        self,
        query: np.ndarray,
        below: list[float],
        above: list[float],
        allowed: np.ndarray,
        low: np.ndarray,
        high: np.ndarray,
        k: int,
    ) -> list[list[tuple[float, int]]]:
        """For each window from ``low`` to ``high``: the first ``k`` allowed rows with products in it,
        largest first, ties by id, as ``(-product, id)``. ``below`` and ``above`` are the bounds of the
        nodes for the query."""
        found: list[list[tuple[float, int]]] = [[] for _ in low]
        least, most = low.tolist(), high.tolist()  # least: what still matters to a window
        heap = [(-above[0], 0)]
        while heap and -heap[0][0] >= min(least):
            node = heapq.heappop(heap)[1]
            if not any(below[node] <= m and above[node] >= x for x, m in zip(least, most)):
                continue
            if self.children[node]:
                for child in range(self.first[node], self.first[node] + self.children[node]):
                    if any(below[child] <= m and above[child] >= x for x, m in zip(least, most)):
                        heapq.heappush(heap, (-above[child], child))
                continue
            start, end = self.start[node], self.end[node]
            products = self.rows[start:end] @ query
            near = np.flatnonzero((products >= min(least)) & (products <= max(most)) & allowed[start:end])
            if not len(near):
                continue
            products, ids = products[near], self.ids[start:end][near]
            for w, (x, m) in enumerate(zip(least, most)):
                fits = np.flatnonzero((products >= x) & (products <= m))
                if len(fits) > k:  # all that could be among the first k, ties included
                    fits = fits[products[fits] >= np.partition(products[fits], -k)[-k]]
                if len(fits):
                    found[w] = heapq.nsmallest(k, [*found[w], *zip((-products[fits]).tolist(), ids[fits].tolist())])
                    if len(found[w]) == k:
                        least[w] = max(x, -found[w][-1][0])
        return found


def _matrix(column: pa.ChunkedArray, rows: np.ndarray) -> np.ndarray:
    """The vectors of some rows; they have one length."""
    part = column.take(pa.array(rows)).combine_chunks()
    return part.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def _build(table: pa.Table, cuts: np.ndarray) -> pa.Table:
    ids, keys, labels = (table.column(c).to_numpy() for c in ("row_id", "row", "label"))
    trees = []
    for first, end in zip(cuts[:-1], cuts[1:]):
        vectors = _matrix(table.column("v"), np.arange(first, end))
        trees.append(CoverTree.build(vectors, ids[first:end], keys[first:end], labels[first:end]).to_bytes())
    firsts = pa.array(cuts[:-1])
    return pa.table({"g": table.column("g").take(firsts), "i": table.column("i").take(firsts), "tree": pa.array(trees, pa.large_binary()).cast(pa.binary())})


Windows = Callable[[list[dict] | None], tuple[np.ndarray, np.ndarray]]


def _search(k: int, same: bool, windows: Windows) -> Callable[[pa.Table, np.ndarray], pa.Table]:
    """Work of a block and its queries: the first ``k`` rows in each of a query's windows, among those
    of its label, without itself, or among those of other labels."""

    def work(table: pa.Table, cuts: np.ndarray) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        is_tree = table.column("tree").is_valid().to_numpy()
        rows, labels = table.column("row").to_numpy(), table.column("label").to_numpy()
        for first, end in zip(cuts[:-1], cuts[1:]):
            here = np.arange(first, end)
            queries = here[~is_tree[here]]
            if len(queries) == len(here) or not len(queries):
                continue
            tree = CoverTree.from_bytes(table.column("tree")[int(here[is_tree[here]][0])].as_py())
            mine = {label: tree.labels == label for label in np.unique(labels[queries])}
            for part in np.array_split(queries, -(-len(queries) // AT_ONCE)):
                vectors = _matrix(table.column("v"), part)
                below, above = tree.bounds(vectors)
                asked = table.column("asked").take(pa.array(part)).to_pylist()
                for n, query in enumerate(part):
                    allowed = mine[labels[query]]
                    allowed = allowed & (tree.keys != rows[query]) if same else ~allowed
                    low, high = windows(asked[n])
                    if not len(low) or not allowed.any():
                        continue
                    best = tree.search(vectors[n], below[n].tolist(), above[n].tolist(), allowed, low, high, k)
                    out += [(int(rows[query]), place, other, int(-less)) for place, rank in enumerate(best) for less, other in rank]
        columns = list(zip(*out)) or [()] * 4
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("row", "place", "other", "score"), columns)})

    return work


def _everything(_: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    return np.array([-np.inf]), np.array([np.inf])


def _shares(lowest: int, highest: int) -> Windows:
    """Windows of whole numbers from ``lowest`` to ``highest`` percent of each positive's score."""

    def windows(asked: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
        scores = [x["score"] for x in asked or ()]
        return np.array([-(-lowest * s // 100) for s in scores], np.float64), np.array([highest * s // 100 for s in scores], np.float64)

    return windows


def _first(found: DataFrame, k: int, *query: str) -> DataFrame:
    """The first ``k`` rows of each query over all blocks, with their ``rank`` from 1."""
    order = W.partitionBy(*query).orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _searched(trees: DataFrame, queries: DataFrame, chunks: int, k: int, same: bool, windows: Windows) -> DataFrame:
    """``row``, ``place``, ``other``, ``score`` of queries (``row``, ``label``, ``v``, ``asked`` and
    the ``g``, ``i`` of a block each) in their blocks."""
    kinds = {c: queries.schema[c].dataType for c in ("row", "label", "v", "asked")}
    held = trees.select("g", "i", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("j"), "tree", *(F.lit(None).cast(t).alias(c) for c, t in kinds.items()))
    asking = queries.select("g", "i", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int").alias("j"), F.lit(None).cast("binary").alias("tree"), *kinds)
    return by_group(held.unionByName(asking), _search(k, same, windows), "row bigint, place bigint, other bigint, score bigint")


def hard_negatives(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    anchor_every: int = 50,
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Hard negatives of each anchor and positive: ``anchor_id``, ``positive_id``, ``rank`` (from 1),
    ``negative_id``, ``positive_score``, ``negative_score``.

    Components are multiplied by ``scale`` and rounded down; a score is the integer inner product with
    the anchor. Higher scores come first, then smaller ids. Anchors are rows whose id ``anchor_every``
    divides. An anchor's positives are its first other rows of its label; negatives of a positive are
    the first rows of other labels whose score is within ``window``, in percent of the positive's.

    Rows without an id, a label or a vector, with a null or non-finite component, or with a scaled
    vector too long for exact products (a norm above 2**26) take no part. Vectors are compared with
    those of their length. Rows are rows of their own, whatever ids and vectors they share: a repeated
    anchor is answered once for each, and its copies are other rows to it. ``label`` is a whole number
    or text. Other columns are ignored, and an empty table gives no rows.
    """
    text = vectors.schema[label].dataType.typeName() in ("string", "char", "varchar")
    named = vectors.select(
        F.col(vec_id).cast("bigint").alias("row_id"),
        # A hash tells whole numbers apart exactly, being a permutation of them.
        F.xxhash64(F.col(label).cast("string" if text else "bigint")).alias("label"),
        F.col(label).isNotNull().alias("labelled"),
        F.col(embedding).cast("array<double>").alias("x"),
    )
    odd = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = named.filter(F.col("row_id").isNotNull() & F.col("labelled") & F.col("x").isNotNull()).filter(~odd)
    scaled = sound.select("row_id", "label", F.transform("x", lambda x: F.floor(x * scale).cast("double")).alias("v"))
    exact = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x) <= EXACT
    groups = F.pmod("label", F.lit(LABEL_GROUPS)) * F.lit(2**32) + F.size("v")
    # Numbers of rows are given once, when the table is written.
    rows = stage(scaled.filter(exact).withColumn("g", groups).withColumn("row", F.monotonically_increasing_id()), "vectors")

    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.ceil(F.col("n") * F.greatest(F.pmod("g", F.lit(2**32)), F.lit(1)) * 8 / block_bytes).cast("int")
    cut = lookup(rows, sizes.select("g", blocks.alias("blocks")), "g")
    cut = cut.select("g", F.pmod(F.xxhash64("row"), "blocks").cast("int").alias("i"), F.lit(0).alias("j"), "row", "row_id", "label", "v")
    trees = stage(by_group(cut, _build, "g bigint, i int, tree binary"), "cover-trees")

    anchors = stage(rows.filter(F.col("row_id") % anchor_every == 0), "anchors")
    chunks = max(1, -(-anchors.count() // QUERIES))
    asked = "array<struct<place:bigint,score:bigint>>"
    own = trees.groupBy("g").agg(F.collect_list("i").alias("blocks"))
    to_own = lookup(anchors, own, "g").select("g", F.explode("blocks").alias("i"), "row", "label", "v", F.lit(None).cast(asked).alias("asked"))
    near = _first(_searched(trees, to_own, chunks, positives, True, _everything), positives, "row")
    near = stage(near.select("row", (F.col("rank") - 1).cast("bigint").alias("place"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    wanted = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", F.col("positive_score").alias("score")))).alias("asked"))
    length = F.pmod("g", F.lit(2**32))
    every = trees.groupBy(length.alias("length")).agg(F.collect_list(F.struct("g", "i")).alias("blocks"))
    asking = anchors.join(wanted, "row").select(length.alias("length"), "row", "label", "v", "asked")
    to_all = lookup(asking, every, "length").select(F.inline("blocks"), "row", "label", "v", "asked")
    found = _searched(trees, to_all, chunks, negatives, False, _shares(*window))
    hard = _first(found, negatives, "row", "place").select("row", "place", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
    named = near.join(anchors.select("row", F.col("row_id").alias("anchor_id")), "row")
    return hard.join(named, ["row", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
