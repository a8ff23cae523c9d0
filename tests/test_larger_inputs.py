"""Queries over inputs as larger runs have them."""

import os
import random
import time
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import queries, tables
from sentiflow.functions.fixed_values import ENGLISH_STOPWORDS
from sentiflow.operators import models, terms

from .conftest import SF


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """The given tables with each of ``conversations`` and ``documents`` as a folder of files."""
    folder = tmp_path_factory.mktemp("tables")
    for name in os.listdir(SF):
        if name in ("conversations.parquet", "documents.parquet"):
            spark.read.parquet(f"{SF}/{name}").repartition(3).write.parquet(str(folder / name))
        else:
            (folder / name).symlink_to(f"{SF}/{name}")
    return str(folder)


@pytest.mark.parametrize("name", ["score_stream", "scored_stream_rows", "stream_batch_log", "stream_rejects"])
def test_streams_read_a_table_that_is_a_folder(spark, folders, name):
    found, expected = (queries.QUERIES[name](spark, sf_dir) for sf_dir in (folders, SF))
    assert expected.count() > 0
    columns = [c for c in expected.columns if not c.endswith("probability")]
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, expected.select(columns).collect()))


def test_the_stream_reads_no_other_table(spark, folders):
    for sf_dir in (folders, SF):
        stream = tables.request_stream(spark, sf_dir).writeStream.format("memory").queryName("requests_read")
        stream.trigger(availableNow=True).start().awaitTermination()
        assert spark.table("requests_read").count() == tables.requests(spark, SF).count()


def test_one_task_does_not_write_all_of_a_large_csv(spark, monkeypatch):
    places, expected = [], queries.csv_split_roundtrip(spark, SF)
    scratch = queries.scratch_path
    monkeypatch.setattr(queries, "scratch_path", lambda s, name: places.append(scratch(s, name)) or places[-1])
    found = queries.csv_split_roundtrip(spark, SF, file_bytes=100_000)
    files = spark.read.format("binaryFile").load(f"{places[0]}/*.csv").select("length").collect()
    total = sum(f["length"] for f in files)
    assert len(files) >= total // 200_000 > 1
    assert found.count() == expected.count() and found.exceptAll(expected).isEmpty()


@pytest.mark.parametrize("name", ["hashing_tf", "vocab_features"])
def test_sums_over_vectors_do_not_widen_them(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().analyzed().toString()
    assert "unwrap_udt" in plan


def test_csv_that_gives_no_row_is_packed(spark, monkeypatch):
    places, scratch = [], queries.scratch_path
    monkeypatch.setattr(queries, "scratch_path", lambda s, name: places.append(scratch(s, name)) or places[-1])
    queries.csv_folder_roundtrip(spark, SF)
    paths = [r.path for r in spark.read.format("binaryFile").load([f"{places[0]}/{n}" for n in range(5)]).select("path").collect()]
    assert {p.split("/")[-2] for p in paths if p.endswith(".csv.gz")} == {"3", "4"}
    assert {p.split("/")[-2] for p in paths if p.endswith(".csv")} == {"0", "1", "2"}


def test_training_vectors_are_made_once(spark, cleaned, monkeypatch):
    given, fit = [], models._fit_learner
    monkeypatch.setattr(models, "_fit_learner", lambda *args: given.append(args[:2]) or fit(*args))
    train = cleaned.filter("label is not null")
    models.fit_vocab(train, size=300, max_iter=2)
    features, rows = given[0]
    assert rows.inputFiles() and all("/training-vectors-" in f for f in rows.inputFiles())
    entries = F.xxhash64(F.unwrap_udt("features")).alias("entries")
    found, expected = (df.select(entries, "label") for df in (rows, features.transform(train)))
    assert found.count() == expected.count() and found.exceptAll(expected).isEmpty()


def _texts(count):
    draw = random.Random(5)
    words = ["", "a", "the", "und", "é", "éé", "x" * 300, "日本", "a\nb"] + [f"w{i}" for i in range(20_000)]
    lengths = [0, 1, 2, 40, 1500]
    return [None if draw.random() < 0.1 else " ".join(draw.choices(words, k=draw.choice(lengths))) for _ in range(count)]


def _plain_counts(texts, min_chars):
    seen, documents, occurrences = 0, Counter(), Counter()
    for text in texts:
        if text is not None:
            words = text.split(" ")
            seen += 1
            occurrences.update(words)
            documents.update(set(words))
    kept = {w: (documents[w], n) for w, n in occurrences.items() if len(w) >= min_chars and w not in ENGLISH_STOPWORDS}
    return ({None: (seen, 0)} if seen else {}) | kept


def _task_counts(texts, min_chars, kind=pa.string()):
    batches = [pa.RecordBatch.from_arrays([pa.array(t, kind)], ["text"]) for t in (texts[:7], [], [None], texts[7:])]
    found = Counter(), Counter()
    for batch in terms._statistics_task(batches, min_chars):
        for word, documents, occurrences in zip(*(c.to_pylist() for c in batch.columns)):
            found[0][word] += documents
            found[1][word] += occurrences
    return {w: (n, found[1][w]) for w, n in found[0].items()}


@pytest.mark.parametrize("size, words", [(8 << 20, 100_000), (2000, 100), (1, 1)])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_word_counts_do_not_depend_on_how_much_is_counted_at_a_time(monkeypatch, size, words, kind):
    monkeypatch.setattr(terms, "COUNTED_BYTES", size)
    monkeypatch.setattr(terms, "COUNTED_WORDS", words)
    for texts in (_texts(80), [""], ["the", None, " "], [None], []):
        for min_chars in (0, 1, 2):
            assert _task_counts(texts, min_chars, kind) == _plain_counts(texts, min_chars)


def test_counting_words_takes_less_than_counting_them_one_by_one():
    texts, took = _texts(4000), {_task_counts: [], _plain_counts: []}
    for _ in range(3):
        for count, seconds in took.items():
            began = time.process_time()
            count(texts, 2)
            seconds.append(time.process_time() - began)
    assert min(took[_task_counts]) < 0.7 * min(took[_plain_counts])
