"""Odd rows in the operators without SQL, the neighbours' vote by brute force, and the whole pipeline
over odd and empty tables."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from sentiflow.llm import quality
from sentiflow.llm.queries import PIECES_MODEL, QUERIES
from sentiflow.sources import stage

from ..conftest import SF
from .test_queries import TABLES, edge_dir  # noqa: F401


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    return quality.fit(docs, labels.filter(~quality.held_out())), [*texts, None, "", "!!!", texts[0], texts[0] * 3]


def test_scores_are_the_vote_of_the_nearest(fitted):
    model, texts = fitted
    scores = model.score(texts)
    vectors = model.vectorise(texts)
    for vector, score in zip(vectors, scores):
        cosines = [sum(float(a) * float(b) for a, b in zip(vector, other)) for other in model.vectors]
        nearest = sorted(range(len(cosines)), key=lambda k: (-round(cosines[k] * 2**40), k))[: model.neighbours]
        votes = [max(cosines[k], 0) ** quality.SHARPNESS for k in nearest]
        share = sum(v * model.labels[k] for v, k in zip(votes, nearest)) / sum(votes) if sum(votes) else 0.5
        assert score == pytest.approx(share, abs=1e-9)


@pytest.mark.parametrize("block", [1, 7, 64])
def test_scores_do_not_depend_on_blocks(fitted, block):
    model, texts = fitted
    blocks = [model.score(texts[i : i + block]) for i in range(0, len(texts), block)]
    assert np.abs(np.concatenate(blocks) - model.score(texts)).max() < 1e-11


def test_equal_neighbours_come_in_the_order_of_the_fit(fitted):
    model, texts = fitted
    n = model.neighbours
    one = model.vectorise([texts[0]])
    tied = quality.Model(model.projection, np.repeat(one, 3 * n, 0), np.array([1.0] * n + [0.0] * 2 * n), n)
    assert tied.score([texts[0]] * 5).tolist() == [1.0] * 5


def rows_of(spark, folder, name="documents"):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def test_classifier_and_encoder_on_odd_rows(spark, edge_dir):  # noqa: F811
    docs = rows_of(spark, edge_dir)
    keys = sorted(str(r.doc_id) for r in docs.select("doc_id").collect())
    scored = QUERIES["op1_quality"](spark, edge_dir).collect()
    assert sorted(str(r.doc_id) for r in scored) == keys
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored)
    library = SentencePieceProcessor(model_file=PIECES_MODEL)

    def digests(text):
        ids = library.encode(text or "", add_eos=True)
        return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()

    expected = sorted((str(r.doc_id), *digests(r.text)) for r in docs.select("doc_id", "text").collect())
    got = QUERIES["op10_pieces"](spark, edge_dir).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == expected


def test_vectors_on_odd_rows(spark, edge_dir):  # noqa: F811
    """Each row once, null and repeated ids as well; unusable vectors alone."""
    table = rows_of(spark, edge_dir, "embeddings")
    got = QUERIES["op9_crosspolytope"](spark, edge_dir).collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(str(r.vec_id) for r in table.select("vec_id").collect())
    alone = {r.vec_id: r.n_links for r in got if r.vec_id in (150, 200, 250, 300, 400, 401)}
    assert alone == dict.fromkeys((150, 200, 250, 300, 400, 401), 0)


def test_pipeline_over_odd_rows(spark, edge_dir, monkeypatch):  # noqa: F811
    # All that the stages after the first are given: odd rows are hardly of good quality.
    monkeypatch.setattr(corpus_pipeline.quality, "good_documents", lambda docs, labels: docs)
    docs = rows_of(spark, edge_dir)
    for name, apply in corpus_pipeline.STAGES:
        after = stage(apply(spark, docs, edge_dir), name.replace(" ", "-"))
        if name == "encoding":
            assert after.count() == docs.count() > 0
        else:
            assert after.columns == docs.columns and after.count() > 0
        if name in ("line dedup", "near dedup"):
            assert after.count() <= docs.count()
        if name == "near dedup":
            texts = [r.text for r in after.collect() if (r.text or "").split()]
            assert len(texts) == len(set(texts))
        docs = after
    decoded = docs.filter(F.col("n_tokens") < 1).count()
    assert decoded == 0


def test_pipeline_as_it_is_over_odd_and_no_rows(spark, edge_dir, tmp_path):  # noqa: F811
    assert corpus_pipeline.run(spark, edge_dir).columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    for table in TABLES:
        rows_of(spark, edge_dir, table).filter("false").write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
