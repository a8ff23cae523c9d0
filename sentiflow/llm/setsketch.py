"""Near-duplicate documents by SetSketch registers.

A document's set of word shingles is sketched in registers: for each of several hash functions the
smallest of the elements' exponential variates, kept as its exponent to a base near 1. Registers of a
union are the larger ones of both, and two sets agree in a register about as often as they overlap.

1. Equal texts are one class. Each class is sketched; bands of registers are bucket keys.
2. Within a bucket, pairs whose likelihood estimate is well below the threshold are ruled out; what is
   left links classes to families. Bands miss a pair of similarity 0.8 with a chance of about 5e-8 and
   the margin one with about 2e-7 (77 of 128 registers or fewer agree): 1 in 4 million together.
   A bucket of very many classes is not searched: all of its classes are candidates.
3. A family of very many elements is split to parts whose sets share one of their rarest shingles, as
   any two sets must that are similar enough (prefix filtering); this loses no link.
4. Families are verified on full sets, and the links found make components.

No step lists pairs: see ``groups``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import lookup
from ..sources.storage import stage
from .common import SPACED_WORD, ascii_lower, text_or_empty
from .groups import EDGES, by_group, by_size, components, edge_table, forest, links_within

REGISTERS = 128
BANDS = 32
BASE = 1.02
#: A pair stays a candidate unless its estimate is below the threshold by this much.
MARGIN = 0.2
#: Rows of a bucket, and set elements of a family, that are compared in one task at most.
BUCKET_ROWS = 4096
FAMILY_ELEMENTS = 2_000_000
SKETCH_ELEMENTS = 100_000

_SEEDS = np.random.default_rng(20240101).integers(1, 2**63, (2, REGISTERS), dtype=np.uint64)
FLIPS, FACTORS = _SEEDS[0], _SEEDS[1] * np.uint64(2) + np.uint64(1)


def words_of(text: Column) -> Column:
    """Words without white space in them, A-Z in lower case."""
    return F.regexp_extract_all(ascii_lower(text), F.lit(SPACED_WORD), F.lit(0))


def shingles(words: Column, k: int) -> Column:
    """Distinct hashes of all runs of ``k`` words; fewer words are one run; no words, none."""
    size = F.size(words)
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(size - (k - 1), F.lit(1))),
        lambda i: F.xxhash64(*(F.get(words, i - 1 + o) for o in range(k))) if k > 1 else F.xxhash64(F.get(words, i - 1)),
    )
    return F.when(size == 0, F.array().cast("array<bigint>")).when(
        size < k, F.array(F.xxhash64(F.array_join(words, " ")))
    ).otherwise(F.array_distinct(runs))


def registers(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Registers of sets that lie in ``flat`` one behind the other; none of them is empty."""
    least = np.empty((REGISTERS, len(starts)), np.uint64)
    for i in range(REGISTERS):
        least[i] = np.minimum.reduceat((flat ^ FLIPS[i]) * FACTORS[i], starts)
    share = (least.T.astype(np.float64) + 1) / 2.0**64
    variate = -np.log1p(-np.minimum(share, 1 - 1e-16))
    return np.clip(np.floor(1 - np.log(variate) / np.log(BASE)), 0, 65535).astype(">u2")


def merged(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(one, other)


def at_least(threshold: float, size: int, sizes: np.ndarray, more: np.ndarray, less: np.ndarray) -> np.ndarray:
    """Whether the maximum-likelihood estimate of the overlap reaches ``threshold``.

    ``more`` and ``less`` count registers in which the first set's value is larger and smaller. The
    likelihood is concave in the overlap, so its slope at the threshold tells.
    """
    u = size / (size + sizes)
    v = 1 - u
    shrink = (BASE - 1) / BASE
    x, y = u - v * threshold, v - u * threshold
    possible = (x > 0) & (y > 0)  # the overlap is at most the ratio of the sizes
    x, y = np.where(possible, x, 0.25), np.where(possible, y, 0.25)
    chance = lambda z: -np.log1p(-z * shrink) / np.log(BASE)
    slope = lambda z: shrink / (np.log(BASE) * (1 - z * shrink))
    px, py = chance(x), chance(y)
    equal = REGISTERS - more - less
    gain = equal * (v * slope(x) + u * slope(y)) / (1 - px - py)
    return possible & (gain >= more * v * slope(x) / px + less * u * slope(y) / py)


def _sketch_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = batch.column(2)
        offsets = sets.offsets.to_numpy()
        start = 0
        while start < len(batch):
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SKETCH_ELEMENTS, "right")) - 1)
            stop = min(stop, len(batch))
            at = offsets[start : stop + 1]
            flat = sets.values.to_numpy()[at[0] : at[-1]].view(np.uint64)
            sizes = np.diff(at)
            full = np.flatnonzero(sizes)
            sketch = np.full((stop - start, REGISTERS), 0, ">u2")
            if len(full):
                sketch[full] = registers(flat, at[:-1][full] - at[0])
            data = pa.array([row.tobytes() for row in sketch], pa.binary())
            rows = batch.slice(start, stop - start)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(sizes, pa.int64()), data], ["doc_id", "id", "n", "registers"])
            start = stop


def _bucket_edges(threshold: float):
    def work(table: pa.Table, cuts: np.ndarray) -> pa.Table:
        sketch = np.frombuffer(b"".join(table.column("registers").to_pylist()), ">u2").astype(np.uint16).reshape(-1, REGISTERS)
        size = table.column("n").to_numpy().astype(np.float64)
        edges = []
        two = np.flatnonzero(np.diff(cuts) == 2)  # most buckets: all at once
        a, b = cuts[two], cuts[two] + 1
        good = at_least(threshold, size[a], size[b], (sketch[a] > sketch[b]).sum(1), (sketch[a] < sketch[b]).sum(1))
        edges += zip(a[good].tolist(), b[good].tolist())
        for k in np.flatnonzero(np.diff(cuts) > 2):
            first, rows, sizes = cuts[k], sketch[cuts[k] : cuts[k + 1]], size[cuts[k] : cuts[k + 1]]

            def linked(i: int, others: np.ndarray, rows=rows, sizes=sizes) -> np.ndarray:
                theirs = rows[others]
                return at_least(threshold, sizes[i], sizes[others], (rows[i] > theirs).sum(1), (rows[i] < theirs).sum(1))

            edges += [(first + i, first + j) for i, j in forest(len(rows), linked)]
        return edge_table(table.column("id").combine_chunks(), edges)

    return work


def _family_edges(percent: int):
    def work(table: pa.Table, cuts: np.ndarray) -> pa.Table:
        sets = table.column("shingles").combine_chunks()
        offsets = sets.offsets.to_numpy()
        values = sets.values.to_numpy()
        edges = []
        for k in range(len(cuts) - 1):
            first, at = cuts[k], offsets[cuts[k] : cuts[k + 1] + 1]
            distinct, flat = np.unique(values[at[0] : at[-1]], return_inverse=True)
            at = at - at[0]
            size = np.diff(at)
            has = np.zeros(len(distinct), bool)

            def linked(i: int, others: np.ndarray, at=at, flat=flat, size=size, has=has) -> np.ndarray:
                has[flat[at[i] : at[i + 1]]] = True
                # Sets that are too small or too large for the threshold need no count.
                near = np.flatnonzero((100 * np.minimum(size[i], size[others]) >= percent * np.maximum(size[i], size[others])))
                out = np.zeros(len(others), bool)
                if len(near):
                    rows = others[near]
                    length = size[rows]
                    ends = np.cumsum(length)
                    places = np.arange(ends[-1]) + np.repeat(at[rows] - ends + length, length)
                    common = np.add.reduceat(has[flat[places]].astype(np.int64), ends - length)
                    out[near] = 100 * common >= percent * (size[i] + length - common)
                has[flat[at[i] : at[i + 1]]] = False
                return out

            edges += [(first + i, first + j) for i, j in forest(len(size), linked)]
        return edge_table(table.column("id").combine_chunks(), edges)

    return work


def _hub(name: str) -> Column:
    """A node that stands for a number, larger than all ids of classes."""
    return F.concat(F.lit("~"), F.col(name).cast("string"))


def _parts(sets: DataFrame, percent: int, limit: int) -> DataFrame:
    """``sets`` (``id``, ``g``, the family, ``shingles`` and ``n``, their number), with families of more
    than ``limit`` elements split.

    A set's shingles are ordered by how many sets of the family have them. Of two sets that are linked,
    the one that is not larger has ``2 * percent / (100 + percent)`` of its ``n`` shingles in common
    with the other one, which has ``percent / 100`` of its own: so they share one that is among the
    first of both, when as many as the rest and one more are taken. Parts are the components of having
    such a shingle; sets that have none are linked with nothing and dropped.
    """
    sums = sets.groupBy("g").agg(F.sum("n").alias("weight"), F.lit(True).alias("large"))
    large = stage(sums.filter(F.col("weight") > limit).select("g", "large"), "large-families")
    if large.isEmpty():
        return sets
    told = lookup(sets, large, "g", "left")
    rows = told.filter("large").drop("large")
    elements = rows.select("id", "n", "g", F.explode("shingles").alias("s")).select("id", "n", F.xxhash64("g", "s").alias("h"))
    shared = stage(elements.groupBy("h").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1"), "shared-shingles")
    known = lookup(elements, shared, "h", "left", counts=shared.withColumnRenamed("sets", "n"))
    place = F.struct(F.coalesce("sets", F.lit(1)).alias("sets"), "h")
    ordered = known.groupBy("id", "n").agg(F.array_sort(F.collect_list(place)).alias("order"))
    among = lambda share: (F.col("n") - F.ceil(share) + 1).cast("int")
    first = F.slice("order", F.lit(1), among(F.col("n") * percent / F.lit(100)))
    in_smaller = F.col("at") < among(F.col("n") * (2 * percent) / F.lit(100 + percent))
    taken = ordered.select("id", "n", F.posexplode(first).alias("at", "p")).select("id", "p.*", in_smaller.alias("in_smaller"))
    taken = stage(taken.filter("sets > 1"), "rare-shingles")
    hubs = taken.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.max("in_smaller").alias("meets"))
    hubs = hubs.filter("meets and n > 1").select("h")
    edges = lookup(taken.select("id", "h"), stage(hubs, "rare-hubs"), "h").select(F.col("id").alias("a"), _hub("h").alias("b"))
    split = components(edges).select(F.col("node").alias("id"), F.xxhash64("root").alias("part"))
    finer = rows.join(split, "id").withColumn("g", F.col("part")).drop("part")
    return told.filter("large is null").drop("large").unionByName(finer)


def _rooted(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``doc_id``, ``id``, ``n_shingles`` and ``root`` (the component, null without words) of each row."""
    rows = docs.select("doc_id", words_of(text_or_empty()).alias("words"))
    rows = rows.select("doc_id", F.md5(F.array_join("words", " ")).alias("id"), "words")
    hashed = rows.select("doc_id", "id", shingles(F.col("words"), k).alias("set"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, id string, n bigint, registers binary"
    sketched = stage(hashed.mapInArrow(_sketch_task, schema), "sketches")

    sketches = sketched.filter("n > 0").groupBy("id").agg(
        F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("registers").alias("registers")
    )
    classes = stage(sketches, "classes")
    width = 2 * REGISTERS // BANDS
    buckets = F.explode(F.array(*(F.xxhash64(F.lit(j), F.substring("registers", j * width + 1, width)) for j in range(BANDS))))
    members, crowded = by_size(classes.select("id", buckets.alias("g")), F.lit(1), BUCKET_ROWS)
    candidates = by_group(members.join(classes.select("id", "n", "registers"), "id"), _bucket_edges(percent / 100 - MARGIN), EDGES)
    if crowded is not None:
        candidates = candidates.unionByName(crowded.select(F.col("id").alias("a"), _hub("g").alias("b")))
    families = components(candidates)

    # The full sets of the families' classes, each made from its first document only.
    wanted = families.withColumnRenamed("node", "id").join(classes.select("id", "doc"), "id")
    again = lookup(rows, wanted, "id").filter(F.col("doc_id").eqNullSafe(F.col("doc")))
    again = again.select("id", "root", shingles(F.col("words"), k).alias("set"))
    sets = again.groupBy("id", "root").agg(F.first("set").alias("shingles"))
    sets = stage(sets.select("id", F.xxhash64("root").alias("g"), "shingles", F.size("shingles").alias("n")), "family-sets")
    parts = _parts(sets, percent, FAMILY_ELEMENTS)
    found = components(links_within(parts, F.col("n"), FAMILY_ELEMENTS, _family_edges(percent)))

    linked = sketched.select("doc_id", "id", F.col("n").alias("n_shingles"))
    rooted = lookup(linked, found.withColumnRenamed("node", "id"), "id", "left")
    return stage(rooted.withColumn("root", F.when(F.col("n_shingles") > 0, F.coalesce("root", "id"))), "rooted")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """For each row of ``docs`` (``doc_id``, ``text``): ``n_shingles``, ``component_id`` (smallest
    ``doc_id`` reachable over links, its own included), ``kept`` (whether that is its own) and ``id``,
    its class of equal texts.

    Documents are linked when 100 times their common shingles of ``k`` words are at least ``percent``
    times all of theirs. Null and empty texts and those without words have no shingles, are linked
    with nothing and kept. Rows with one ``doc_id`` are documents of their own; a null ``doc_id`` is
    larger than any other and stays where the whole component has no other. Other columns are ignored.
    """
    rooted = _rooted(docs, k, percent)
    least = rooted.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    least = least.filter("rows > 1").select("root", "least")
    return lookup(rooted, least, "root", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("least", "doc_id").alias("component_id"),
        (F.coalesce("least", "doc_id").eqNullSafe(F.col("doc_id"))).alias("kept"),
        "id",
    )


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with all columns, exactly one row of each component and all rows without words.

    The row that stays has the component's smallest ``doc_id``, a null one being larger than any
    other. Among several such rows go by the class of equal texts, then by a digest of all columns.
    """
    rooted = _rooted(docs.select("doc_id", "text"), k, percent)
    # A null doc_id is told apart from an empty one.
    number = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("")).alias("doc_id")
    here = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "id")
    firsts = rooted.filter("root is not null").groupBy("root").agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("rows"))
    firsts = firsts.filter("rows > 1").select("root", "first")
    # Of the keys in components of several rows, only the first one stays, and that may be repeated.
    fates = (
        lookup(rooted.select("root", "doc_id", "id"), firsts, "root")
        .groupBy(F.struct(number, "id").alias("key"))
        .agg(F.count(F.lit(1)).alias("rows"), F.max(here.eqNullSafe(F.col("first"))).alias("stays"))
    )
    fates = stage(fates.filter("not stays or rows > 1").select("key", "stays"), "near-duplicates")
    id_ = F.md5(F.array_join(words_of(text_or_empty()), " ")).alias("id")
    rows = docs.select(F.struct("*").alias("row"), F.struct(number, id_).alias("key"))
    single = lookup(rows, fates, "key", "left").filter("stays is null").select("row.*")
    repeated = fates.filter("stays")
    if repeated.isEmpty():
        return single
    digest = F.md5(F.to_json("row"))
    once = lookup(rows, repeated, "key").groupBy("key").agg(F.min_by("row", digest).alias("row"))
    return single.unionByName(once.select("row.*"))
