"""Spelling variants, token counts and hard negatives against brute force."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from sentiflow.llm import covertree, spelling, tokencounts

from .helpers import documents

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def spelled(words, least=6, count=5, ratio=5):
    """``form, root, n, n_near, form_n`` by word."""
    n = {w: k for w, k in Counter(words).items() if w and len(w) >= least and k >= count}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def words_of(rng, count):
    """Words over few letters, so that many are near each other, anagrams among them."""
    words = []
    for _ in range(count):
        word = [rng.choice("aabé") for _ in range(rng.randint(5, 8))]
        words += ["".join(word)] * rng.choice([1, 5, 6, 30, 200])
    return words


@pytest.mark.parametrize("bucket_words", [1, 5, spelling.BUCKET_WORDS])
def test_spelling_equals_brute_force(spark, bucket_words):
    rng = random.Random(bucket_words)
    words = words_of(rng, 250) + ["letters", "leters", "lettres"] * 5 + [None, "", "short", "few letters"]
    table = spark.createDataFrame([(w, "x", 1) for w in words], "word string, key string, n int")
    rows = spelling.variants(table, bucket_words=bucket_words).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == spelled(words)
    assert len(rows) == len({r.word for r in rows})


def test_spelling_follows_forms_of_forms(spark):
    chain = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125}
    words = [w for w, n in chain.items() for _ in range(n)]
    rows = {r.word: r for r in spelling.variants(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert [rows[w].root for w in chain] == ["aabbbb"] * 5
    assert rows["aaaaaa"].form == "aaaaab" and rows["aabbbb"].form is None


def test_spelling_takes_the_smallest_of_equally_frequent_forms(spark):
    words = ["words x".replace(" x", c) for c in "zéa" for _ in range(25)] + ["wordsb"] * 5
    rows = {r.word: r for r in spelling.variants(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert (rows["wordsb"].form, rows["wordsb"].n_near) == ("wordsa", 3)


def test_halves_are_shared_by_all_near_words(spark):
    rng = random.Random(3)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("abç") for _ in range(rng.randint(2, 9)))
        at = rng.randrange(len(a))
        pairs += [(a, a[:at] + a[at + 1 :]), (a, a[:at] + "x" + a[at + 1 :]), (a, a[:at] + "y" + a[at:])]
    pairs = [p for p in pairs if min(map(len, p)) >= 2]
    table = spark.createDataFrame(pairs, "a string, b string")
    shared = F.arrays_overlap(spelling.halves(F.col("a")), spelling.halves(F.col("b")))
    assert table.filter(~shared).count() == 0


def test_spelling_groups_a_large_family_of_one_signature(spark):
    """Anagrams share all signatures; none is near another, and each is near its own misspelling."""
    rng = random.Random(8)
    family = {"".join(rng.sample("abcdefgh", 8)) for _ in range(600)}
    words = [w for w in family for _ in range(30)] + [w + "z" for w in family for _ in range(5)]
    found = spelling.variants(spark.createDataFrame([(w,) for w in words], "word string"))
    expected = spelled(words)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect()} == expected


def test_letter_runs(spark):
    docs = documents(spark, [None, "", "ÄbÇ x1y×z İA", "ÿ÷É"])
    assert [(r.doc_id, r.run) for r in spelling.letter_runs(docs).collect()] == [
        (2, "ÄbÇ"), (2, "x"), (2, "y×z"), (2, "a"), (3, "ÿ÷É"),
    ]


def token_texts(rng):
    alphabet = ["a", "the", " ", " ", "  ", "\n", "\t", "▁", "é", "語", "🙂", "\r\n", "</s>", "<unk>", "<0x0A>", " ", "\x00", "ing", "-", "1"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    return [None, "", " ", "\n", "   \n  ", " a", "a ", "▁", "word " * 20_000, "x" * 30_000, " " * 5_000, *texts]


@pytest.mark.parametrize("frequent", [3, 200, tokencounts.FREQUENT])
def test_token_counts_equal_the_library(spark, frequent):
    texts = token_texts(random.Random(frequent))
    docs = documents(spark, texts).withColumns({c: F.lit("clash") for c in ("key", "row", "words", "n")}).repartition(4)
    rows = {r.doc_id: (r.n_bytes, r.n_tokens) for r in tokencounts.count_tokens(docs, MODEL, frequent=frequent).collect()}
    library = SentencePieceProcessor(model_file=MODEL)
    assert rows == {i: (len((t or "").encode()), len(library.encode(t or ""))) for i, t in enumerate(texts)}


def test_token_counts_keep_repeated_and_null_ids(spark):
    table = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "x"), (None, "x y z"), (None, None)], "doc_id int, text string")
    rows = tokencounts.count_tokens(table, MODEL, frequent=1).orderBy("doc_id", "n_bytes").collect()
    library = SentencePieceProcessor(model_file=MODEL)
    assert [(r.doc_id, r.n_bytes) for r in rows] == [(None, 0), (None, 1), (None, 5), (1, 7), (1, 7)]
    assert [r.n_tokens for r in rows] == [len(library.encode(t)) for t in ("", "x", "x y z", "one two", "one two")]
    assert tokencounts.count_tokens(table.filter("false"), MODEL).count() == 0


def test_rare_pre_tokens_that_tasks_report_add_up(spark):
    """Reports are cut anywhere: what is frequent changes, counts do not."""
    texts = [" ".join(f"w{i % k}" for i in range(200)) for k in range(1, 60)]
    docs = documents(spark, texts)
    whole = sorted(map(tuple, tokencounts.count_tokens(docs.repartition(1), MODEL, frequent=50).collect()))
    assert whole == sorted(map(tuple, tokencounts.count_tokens(docs.repartition(7), MODEL, frequent=50).collect()))


def mined(rows, every=50, positives=5, negatives=3):
    """Hard negatives by brute force, of sound rows (id, vector, label)."""
    scaled = [(i, np.floor(256 * np.array(v, np.float64)), label) for i, v, label in rows]
    out = []
    for k, (anchor, q, mine) in enumerate(scaled):
        if anchor % every:
            continue
        scores = [(-int(q @ v), i, label == mine) for n, (i, v, label) in enumerate(scaled) if n != k and len(v) == len(q)]
        same, others = sorted(s for s in scores if s[2]), sorted(s for s in scores if not s[2])
        for less, positive, _ in same[:positives]:
            fits = [s for s in others if 50 * -less <= 100 * -s[0] <= 95 * -less][:negatives]
            out += [(anchor, positive, n + 1, s[1], -less, -s[0]) for n, s in enumerate(fits)]
    return sorted(out)


def vectors_of(rng, n, labels, clusters=12, width=16):
    centres = rng.normal(size=(clusters, width))
    rows = centres[rng.integers(clusters, size=n)] + rng.normal(size=(n, width)) * rng.choice([0, 0.05, 0.6], size=(n, 1))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    return [(int(i), [float(np.float32(x)) for x in row], labels(int(rng.integers(10)))) for i, row in enumerate(rows)]


@pytest.mark.parametrize("block_bytes", [4_000, 40_000, covertree.BLOCK_BYTES])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(covertree, "QUERIES", 10)
    rng = np.random.default_rng(block_bytes)
    rows = vectors_of(rng, 1500, lambda k: k)
    rows += [rows[50], rows[50], (3, rows[100][1], rows[100][2]), (2000, [0.0] * 16, 1), (2050, [-x for x in rows[0][1]], 1)]
    rows += [(2100, [0.5] * 3, 1), (2101, [0.4, 0.5, 0.5], 1), (2102, [0.3] * 3, 2), (2150, [], 1), (2151, [], 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(5)
    found = covertree.hard_negatives(table, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, found)) == mined(rows)


def test_hard_negatives_of_text_labels_leave_unusable_rows_out(spark):
    rng = np.random.default_rng(5)
    rows = vectors_of(rng, 400, lambda k: f"label {k % 3}")
    odd = [(0, None, "label 1"), (0, [None] + [1.0] * 15, "label 1"), (50, [float("nan")] * 16, "label 1"), (50, [1e300] * 16, "label 1"), (None, [1.0] * 16, "label 1"), (100, [1.0] * 16, None)]
    table = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>, label string")
    assert sorted(map(tuple, covertree.hard_negatives(table).collect())) == mined(rows)
    assert covertree.hard_negatives(table.filter("false")).count() == 0


def test_tree_bounds_hold_and_prune(spark):
    rng = np.random.default_rng(1)
    rows = np.array([v for _, v, _ in vectors_of(rng, 3000, lambda k: k)])
    vectors = np.floor(256 * rows)
    ids = np.arange(len(vectors))
    tree = covertree.CoverTree.from_bytes(covertree.CoverTree.build(vectors, ids, ids, ids % 10).to_bytes())
    assert sorted(tree.ids) == list(ids)
    nodes = np.arange(len(tree.radius))
    leaves = nodes[tree.children == 0]
    assert sum(tree.end[leaves] - tree.start[leaves]) == len(vectors)
    low, high = tree.bounds(vectors[:20])
    for query, below, above in zip(vectors, low, high):
        products = tree.rows @ query
        for n in nodes:
            part = products[tree.start[n] : tree.end[n]]
            assert below[n] <= part.min() and part.max() <= above[n]
    anything = np.ones(len(vectors), bool)
    read = []

    class Noted(np.ndarray):
        def __getitem__(self, rows):
            read.append(rows)
            return np.asarray(self)[rows]

    tree.rows = tree.rows.view(Noted)
    best = tree.search(vectors[0], low[0].tolist(), high[0].tolist(), anything, np.array([-np.inf]), np.array([np.inf]), 5)
    assert [-s for s, _ in best[0]] == sorted(vectors @ vectors[0], reverse=True)[:5]
    assert 0 < sum(part.stop - part.start for part in read) < 0.6 * len(vectors)
