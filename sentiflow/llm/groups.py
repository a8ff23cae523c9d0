"""Work within groups of candidates, and the components their links make.

Groups of any size are cut into pieces, so a task has a bounded number of rows. Tasks return the edges
of a spanning forest, at most one per row, never all pairs. Components are then found by contraction.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookup import lookup
from ..sources.storage import stage

EDGES = "a string, b string"
#: Rows of a group above the limit that are in each of its pieces.
PIVOTS = 16


def by_size(rows: DataFrame, weight: Column, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` (``g``, the group, ``id`` and others) of groups whose weights sum to ``limit`` at most,
    with ``i`` and ``j`` 0, and rows of larger groups, with ``blocks``: how many pieces of half the
    limit they make. Groups of one row are dropped; None where no group is larger."""
    sums = rows.groupBy("g").agg(F.count(F.lit(1)).alias("rows"), F.sum(weight).alias("weight"))
    sums = stage(sums.filter("rows > 1").select("g", "weight"), "group-sizes")
    small = sums.filter(F.col("weight") <= limit).select("g", F.lit(0).alias("i"), F.lit(0).alias("j"))
    large = sums.filter(F.col("weight") > limit)
    if large.isEmpty():
        return rows.join(small, "g"), None
    told = lookup(rows, large.select("g", F.ceil(F.col("weight") * 2 / limit).cast("int").alias("blocks")), "g", "left")
    return told.filter("blocks is null").drop("blocks").join(small, "g"), told.filter("blocks is not null")


def links_within(
    rows: DataFrame,
    weight: Column,
    limit: int,
    work: Callable[[pa.Table, np.ndarray], pa.Table],
    attach: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Edges between the ids of linked ``rows`` (``g``, the group, ``id`` and others) of a group, which
    join all that its links join. ``work`` finds them in whole pieces; ``attach`` adds what it needs.

    A group above ``limit`` is cut into pieces. A few of its rows are in every piece, so that rows that
    are much alike become one component in one pass. Then only the rows outside the group's largest
    component meet all pieces: pairs within that component need no comparison. Where those rows fit
    half the limit, no more than twice the group's rows are shuffled; beyond that they are cut as well,
    and the rows grow with the product of both numbers of pieces.
    """
    small, large = by_size(rows, weight, limit)
    found = by_group(attach(small), work, EDGES)
    if large is None:
        return found
    piece = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    pieces = F.sequence(F.lit(0), F.col("blocks") - 1)
    shuffled = Window.partitionBy("g").orderBy(F.xxhash64(F.lit("pivot"), "id"), "id")
    pivots = large.withColumn("place", F.row_number().over(shuffled)).filter(F.col("place") <= PIVOTS).drop("place")
    others = pivots.withColumn("i", F.explode(F.filter(pieces, lambda k: k != piece)))
    visits = large.withColumn("i", piece).unionByName(others).withColumn("j", F.lit(-1)).drop("blocks")
    first = stage(by_group(attach(visits), work, EDGES), "piece-edges")

    roots = components(first).withColumnRenamed("node", "id")
    rooted = lookup(large, roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    parts = rooted.groupBy("g", "root").agg(F.sum(weight).alias("weight"))
    left = parts.groupBy("g").agg(F.max(F.struct("weight", "root")).alias("main"), F.sum("weight").alias("weight"))
    left = left.select("g", F.col("main.root").alias("main"), (F.col("weight") - F.col("main.weight")).alias("rest"))
    left = left.filter("rest > 0").select("g", "main", F.ceil(F.col("rest") * 2 / limit).cast("int").alias("rests"))
    left = stage(left, "groups-left")
    if left.isEmpty():
        return found.unionByName(first)
    rest = F.pmod(F.xxhash64(F.lit("rest"), "id"), F.col("rests")).cast("int")
    cell = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    met = F.transform(F.sequence(F.lit(0), F.col("rests") - 1), lambda r: cell(r, piece))
    asked = F.when(F.col("root") != F.col("main"), F.transform(pieces, lambda k: cell(rest, k)))
    cells = F.array_union(met, F.coalesce(asked, F.slice(met, 1, 0)))
    meetings = lookup(rooted, left, "g").withColumn("cell", F.explode(cells))
    meetings = meetings.withColumn("i", F.col("cell.i")).withColumn("j", F.col("cell.j"))
    meetings = meetings.drop("cell", "blocks", "rests", "root", "main")
    return found.unionByName(first).unionByName(by_group(attach(meetings), work, EDGES))


def in_blocks(rows: DataFrame, weight: Column, limit: int) -> DataFrame:
    """``rows`` (``g``, the group, ``id`` and others), ``block``, each row's own, and ``i``, ``j``: the
    pair of blocks they meet in, for work that has to see each pair of a group once.

    A group whose weights sum to more than ``limit`` has several blocks, which meet each other and
    themselves: its rows are repeated once for each block. Groups of one row are dropped.
    """
    sums = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("weight"))
    sizes = sums.filter("n > 1").select("g", F.ceil(F.col("weight") / limit).cast("int").alias("blocks"))
    cut = lookup(rows, stage(sizes, "group-sizes"), "g")
    cut = cut.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = cut.withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("i", F.least("block", "mate")).withColumn("j", F.greatest("block", "mate"))
    return met.drop("blocks", "mate")


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Slices of sorted batches that hold whole groups."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in ("g", "i", "j")], 1)
        starts = np.flatnonzero(np.r_[last is None or bool((keys[0] != last).any()), (keys[1:] != keys[:-1]).any(1)])
        last = keys[-1]
        if not len(starts):
            kept.append(batch)
            continue
        # Up to the last start, all groups are whole.
        kept.append(batch.slice(0, starts[-1]))
        table = pa.Table.from_batches(kept)
        if len(table):
            yield table
        kept = [batch.slice(starts[-1])]
    if kept and sum(map(len, kept)):
        yield pa.Table.from_batches(kept)


def by_group(rows: DataFrame, work: Callable[[pa.Table, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """Call ``work`` with whole groups (``g``, ``i``, ``j``), many at a time, and the places where each
    begins, with the end added."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            table = table.combine_chunks()
            keys = np.stack([table.column(k).to_numpy() for k in ("g", "i", "j")], 1)
            cuts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1), True])
            yield from work(table, cuts).to_batches()

    order = ("g", "i", "j")
    return rows.repartition(*order).sortWithinPartitions(*order).mapInArrow(task, schema)


def forest(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges of a spanning forest of ``n`` rows. ``linked(i, others)`` says which others are linked.

    Breadth first: a row is compared only with rows that no tree has reached yet, so a group whose
    rows are all alike takes one comparison each.
    """
    edges, free = [], np.arange(n)
    while len(free):
        waiting, free = deque([free[0]]), free[1:]
        while waiting and len(free):
            i = waiting.popleft()
            found = linked(i, free)
            edges += [(i, k) for k in free[found]]
            waiting.extend(free[found])
            free = free[~found]
    return edges


def edge_table(ids: pa.Array, edges: list[tuple[int, int]]) -> pa.Table:
    ends = np.array(edges, np.int64).reshape(-1, 2)
    return pa.table({"a": ids.take(pa.array(ends[:, 0])), "b": ids.take(pa.array(ends[:, 1]))})


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every end of ``edges`` (``a``,
    ``b``).

    In each round every root hooks to the smallest neighbour below it, the trees are flattened by
    pointer jumping, and edges are carried over to the roots. Edges within a component vanish, so
    each round's table is smaller; nothing but counts reaches the driver.
    """

    def oriented(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        return stage(ends.filter("a != b").distinct(), "edges")

    rounds: list[DataFrame] = []
    left = oriented(edges)
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    while not left.isEmpty():
        hooks = stage(left.groupBy("a").agg(F.min("b").alias("root")), "hooks")
        while True:
            over = hooks.select(F.col("a").alias("root"), F.col("root").alias("top"))
            jumped = lookup(hooks, over, "root", "left")
            moved = stage(jumped.select("a", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")), "hooks")
            hooks = moved.select("a", "root")
            if moved.filter("moved").isEmpty():
                break
        rounds.append(hooks)
        for end in ("a", "b"):
            to = hooks.select(F.col("a").alias(end), F.col("root").alias("to"))
            left = lookup(left, to, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
        left = oriented(left)
    found = nodes.withColumn("root", F.col("node"))
    for hooks in rounds:
        to = hooks.select(F.col("a").alias("root"), F.col("root").alias("to"))
        found = lookup(found, to, "root", "left").withColumn("root", F.coalesce("to", "root")).drop("to")
    return stage(found.select("node", "root"), "components")
