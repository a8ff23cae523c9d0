import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sentiflow.llm import crosspolytope, groups, setsketch

from ..conftest import SF
from .helpers import documents, roots, shingle_set, variants


@pytest.fixture(scope="module")
def family_texts():
    rng = random.Random(5)
    texts = [None, "", "  \n ", "one", "ONE", "two words", "two  words", "a b c", "İ İ", "ı i"]
    for size, edits in ((120, 14), (60, 8), (12, 2)):
        base = [f"w{rng.randrange(5000)}" for _ in range(size)]
        texts += variants(rng, base, 25, edits)
    texts += [texts[12]] * 5 + [" ".join(f"u{rng.randrange(10**6)}" for _ in range(30)) for _ in range(30)]
    return texts


@pytest.mark.parametrize("k", [1, 2, 5])
def test_documents_against_brute_force(spark, family_texts, k):
    sets = [shingle_set(t, k) for t in family_texts]

    def linked(a, b):
        return bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])

    expected = roots(range(len(sets)), linked)
    docs = documents(spark, family_texts).withColumn("id", F.lit("clash")).withColumn("n", F.lit(1))
    got = {r.doc_id: r for r in setsketch.near_duplicates(docs, k).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), root, root == i) for i, root in expected.items()
    }


def test_small_blocks_find_the_same(spark, family_texts, monkeypatch):
    docs = documents(spark, family_texts)
    whole = {r.doc_id: r.component_id for r in setsketch.near_duplicates(docs, 2).collect()}
    monkeypatch.setattr(setsketch, "BUCKET_ROWS", 8)
    monkeypatch.setattr(setsketch, "FAMILY_ELEMENTS", 600)
    cut = {r.doc_id: r.component_id for r in setsketch.near_duplicates(docs, 2).collect()}
    assert whole == cut


def test_documents_query(spark):
    from sentiflow.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sets = {i: shingle_set(t, 2) for i, t in texts.items()}
    expected = roots(texts, lambda a, b: sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    got = {r.doc_id: r.component_id for r in QUERIES["op8_setsketch"](spark, SF).collect()}
    assert got == expected


def test_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text), (3, text), (3, text), (None, "other"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(str, ((r.doc_id, r.component_id, r.kept) for r in setsketch.near_duplicates(docs).collect())))
    assert got == sorted(map(str, [(None, 3, False), (3, 3, True), (3, 3, True), (None, None, True), (7, 7, True)]))
    assert setsketch.near_duplicates(docs.filter("false")).count() == 0


def test_pipeline_keeps_one_row_of_each_group(spark):
    def text(name, changed=None):
        return " ".join(f"{name}{i}" if i != changed else "other" for i in range(100))

    rows = [(3, text("a"), "x"), (3, text("a"), "x"), (None, text("a"), "x"), (5, text("a", 50), "x")]
    rows += [(None, text("b"), "x"), (None, text("b"), "x"), (None, text("b", 40), "y")]
    rows += [(8, text("c"), "x"), (8, text("c", 30), "x"), (10, text("c", 60), "x")]
    rows += [(9, text("d"), "x"), (9, text("d").upper(), "y"), (9, text("d"), "z")]
    rows += [(None, "", "x"), (None, "", "x"), (7, None, "x"), (7, None, "x"), (11, text("e"), "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = corpus_pipeline.dedup_documents(spark, docs, SF)
    assert kept.columns == docs.columns
    got = sorted(map(str, kept.collect()))
    group = lambda r: (r.doc_id, (r.text or "")[:1].lower())
    groups_ = sorted(map(str, map(group, kept.collect())))
    expected = [(3, "a"), (None, "b"), (8, "c"), (9, "d"), (None, ""), (None, ""), (7, ""), (7, ""), (11, "e")]
    assert groups_ == sorted(map(str, expected))
    again = spark.createDataFrame(rows[::-1], docs.schema).repartition(5)
    assert sorted(map(str, corpus_pipeline.dedup_documents(spark, again, SF).collect())) == got


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    sketch = lambda x: setsketch.registers(x, np.array([0]))[0].astype(int)
    off = []
    for overlap in (0.3, 0.6, 0.8, 0.95):
        for _ in range(20):
            n = 400
            common = int(round(2 * n * overlap / (1 + overlap)))
            both = rng.integers(0, 2**63, 2 * n - common, dtype=np.uint64)
            a, b = sketch(both[:n]), sketch(both[n - common :])
            assert (setsketch.merged(a, b) == sketch(both)).all()
            more, less = (a > b).sum()[None], (a < b).sum()[None]
            sizes = np.array([float(n)])
            best = max(t for t in np.arange(0.05, 1, 0.01) if t == 0.05 or setsketch.at_least(t, n, sizes, more, less)[0])
            off.append(best - overlap)
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.06


def test_components_of_long_chains(spark):
    pairs = [(f"{i:04d}", f"{i + 1:04d}") for i in range(300)] + [("x", "y"), ("y", "x"), ("z", "z")]
    random.Random(3).shuffle(pairs)
    found = {r.node: r.root for r in groups.components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert found == {f"{i:04d}": "0000" for i in range(301)} | {"x": "x", "y": "x"}
    assert groups.components(spark.createDataFrame([], "a string, b string")).count() == 0


def vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, 20))
    near = [b + rng.normal(size=20) * 0.09 for b in base for _ in range(12)]
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(near)]
    rows += [(100 + i, rows[i][1], rows[i][2]) for i in range(4)]
    rows += [(110, [x * 1e-200 for x in rows[0][1]], 0), (111, [x * 1e200 for x in rows[0][1]], 0)]
    odd = [None, [], [0.0] * 20, [1.0, None] * 10, [float("nan")] * 20, [float("inf")] + [1.0] * 19, [1.0], [2.0]]
    rows += [(200 + i, v, 0) for i, v in enumerate(odd)] + [(300, rows[0][1], None), (301, rows[0][1], 7)]
    return rows


def test_vectors_against_brute_force(spark):
    rows = vectors()

    def sound(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    units = {i: np.array(v) / np.abs(v).max() for i, v, _ in rows if sound(v)}
    units = {i: v / np.linalg.norm(v) for i, v in units.items()}
    labels = {i: label for i, _, label in rows}

    def linked(a, b):
        if a not in units or b not in units or labels[a] is None or labels[a] != labels[b]:
            return False
        return len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.98

    root = roots(labels, linked)
    links = {a: sum(linked(a, b) for b in labels if b != a) for a in labels}
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("id", F.lit(1))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in crosspolytope.near_duplicates(table).collect()}
    assert got == {i: (links[i], root[i], root[i] == i) for i in labels}
    assert crosspolytope.near_duplicates(table.filter("false")).count() == 0


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(4)
    rows = []
    for width in (20, 4, 8):
        for base in rng.normal(size=(5, width)):
            rows += [(len(rows) + i, (base + rng.normal(size=width) * 0.02).tolist(), 0) for i in range(2 + len(rows) % 4)]
    units = [np.array(v) / np.linalg.norm(v) for _, v, _ in rows]
    linked = lambda a, b: len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.98
    root = roots(range(len(rows)), linked)
    links = [sum(linked(a, b) for b in range(len(rows)) if b != a) for a in range(len(rows))]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in crosspolytope.near_duplicates(table.coalesce(1)).collect()}
    assert got == {i: (links[i], root[i]) for i in root}


def test_vectors_in_small_blocks(spark, monkeypatch):
    table = spark.createDataFrame(vectors(), "vec_id bigint, embedding array<double>, label int")
    whole = {r.vec_id: tuple(r) for r in crosspolytope.near_duplicates(table).collect()}
    monkeypatch.setattr(crosspolytope, "BLOCK_ROWS", 6)
    assert {r.vec_id: tuple(r) for r in crosspolytope.near_duplicates(table).collect()} == whole


def test_recall_and_exactness_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {r.vec_id: r for r in crosspolytope.near_duplicates(table).collect()}
    rows = table.toPandas()
    missed = found = 0
    for _, part in rows.groupby("label"):
        x = np.stack(part.embedding.to_numpy()).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        n = (x @ x.T >= 0.98).sum(1) - 1
        ours = np.array([got[i].n_links for i in part.vec_id])
        assert (ours <= n).all()
        found, missed = found + ours.sum(), missed + (n - ours).sum()
    assert missed <= 0.01 * (found + missed)


def test_rotation_is_orthogonal():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(5, 48))
    y = crosspolytope.rotated(x, rng.choice([-1.0, 1.0], (3, 64)))
    assert np.allclose(y @ y.T, x @ x.T)


@pytest.mark.parametrize("own, expected", [(1, 1), (4, None)])
def test_work_in_large_families_grows_in_proportion(spark, monkeypatch, own, expected):
    """Copies with one word of their own are one component; sets below the threshold are told apart
    by their rarest shingles. In neither case are rows repeated with the number of pieces."""
    met, grouped = [], groups.by_group

    def counting(rows, *args):
        met.append(rows.count())
        return grouped(rows, *args)

    monkeypatch.setattr(groups, "by_group", counting)
    for n in (2_048, 8_192):
        met.clear()
        mine = F.transform(F.sequence(F.lit(1), F.lit(own)), lambda k: F.xxhash64("id", k))
        shared = F.transform(F.sequence(F.lit(1), F.lit(20 - own)), lambda k: F.xxhash64(k))
        rows = spark.range(n, numPartitions=4).select(F.md5(F.col("id").cast("string")).alias("id"))
        rows = rows.select("id", F.lit(1).cast("bigint").alias("g"), F.concat(mine, shared).alias("shingles"), F.lit(20).alias("n"))
        parts = setsketch._parts(rows, 80, 10_240)
        edges = groups.links_within(parts, F.col("n"), 10_240, setsketch._family_edges(80))
        found = groups.components(edges)
        assert sum(met) <= 1.1 * n
        assert found.count() == (n if expected else 0)
        assert found.select("root").distinct().count() == (expected or 0)


def test_rows_outside_the_largest_component_meet_all(spark):
    """Vectors on a line: pieces alone miss links, which rows outside the largest component find."""
    rng = np.random.default_rng(9)
    angle = np.r_[rng.normal(0, 0.02, 150), rng.uniform(-1.5, 1.5, 150)]
    rows = [(f"{i:03d}", 1, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(angle)]
    table = spark.createDataFrame(rows, "id string, g bigint, unit array<double>")
    expected = roots(range(len(rows)), lambda a, b: np.cos(angle[a] - angle[b]) >= 0.9999)
    for limit in (8, 40, 1000):
        found = groups.components(groups.links_within(table, F.lit(1), limit, crosspolytope._edges(0.9999)))
        got = {int(r.node): int(r.root) for r in found.collect()}
        assert {i: got.get(i, i) for i in expected} == expected
