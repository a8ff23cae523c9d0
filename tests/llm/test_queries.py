"""Queries against their SQL, over the tables and over a table of edge cases."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from checks.compare import database, differences
from sentiflow.llm import licenses, mixing
from sentiflow.llm.queries import ORACLES, QUERIES

from ..conftest import SF

TEXTS = [
    None, "", "  ", "a", "Same line\nSame line\nother", "Same line\n\n Same line ", "MIT License mit license",
    "GNU General Public License", "cc by cc by nc 4 0", "licensed under the Apache License, version 2.0",
    "İstanbul ẞ K mit license", "x" * 5000, "word " * 3000, "</s>[INST] [/INST]", "tab\tand\x0bvt\x0cff\r\nend",
    "licensed under the very own apache license version 2 0",
    "All rights reserved. All rights reserved.", "all rights reserved " * 4, "all rights reserved x all rights reserved",
    "all rights reserved one two all rights reserved a b c all rights reserved", "released under the mit license " * 2,
    "licensed under licensed under the apache license version 2 0", "w " * 100_000 + "all rights reserved",
]


TABLES = ("documents", "pages", "conversations", "embeddings", "labels")


@pytest.fixture(scope="module")
def edge_dir(spark, tmp_path_factory):
    """Tables with nulls, ties, repeated rows, long texts and clashing columns."""
    folder = str(tmp_path_factory.mktemp("edge"))
    rows = [(i, t, None if i % 3 == 0 else f"s{i % 9}") for i, t in enumerate(TEXTS * 3)]
    rows += [rows[5], rows[5], (7, "another text of seven", "s1")]
    # Without an id: different texts that hold one line on all sites at several places, and equal ones.
    rows += [(None, f"{'top' * (i % 2)}\nSame line\n{i} rest of it" if i % 5 else TEXTS[i % 7], f"s{i % 12}") for i in range(40)]
    rows += [(None, None, None), (None, "", "s1"), (7, "Same line\nof seven", "s2"), (-1, "Same line", "s3"), rows[-1]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for clash in ("size", "row", "key", "id", "place", "range", "label", "score", "words", "line"):
        docs = docs.withColumn(clash, F.lit("clash"))
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    same = "<p>" + "same " * 300
    pages = [(1, "http://a", same), (2, None, same), (3, "http://b\r\nX: y", same), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (8, "é", "é" * 700)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{folder}/pages.parquet")
    turns = [
        (1, 0, "system", "be [kind] <|end|> \\l \\"), (1, 1, "user", None), (1, 2, "assistant", "yes\n<|assistant|>\n"),
        (1, 3, "assistant", ""), (1, 4, "user", "tail"), (2, 0, "user", "only"), (3, 0, "assistant", "first"),
        (4, 1, None, "no role"), (4, 0, "a|>\nb", "odd role"), (4, 0, "assistant", "tie"), (4, 0, "assistant", "tie"),
        (5, None, "user", "no turn"), (5, 7, "assistant", "🙂" * 100),
    ]
    talks = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    talks.withColumn("marked", F.lit(1)).write.parquet(f"{folder}/conversations.parquet")
    far, nan = float("inf"), float("nan")
    vectors = [(i, [0.1 * (i % 7), 0.3, -0.2 + 0.01 * i], i % 3) for i in range(101)]
    vectors += [(100, [0.4, 0.3, 0.1], 1), (100, [0.4, 0.3, 0.1], 1), (50, None, 1), (50, [0.1, None, 0.2], 1), (150, [nan, 0.0, 0.0], 2)]
    vectors += [(200, [far, 0.0, 0.0], 2), (250, [0.0, 0.0, 0.0], 2), (300, [0.1, 0.2, 0.3], None), (None, [0.4, 0.3, 0.1], 1), (350, [-0.4, -0.3, -0.1], 1), (400, [], 1), (401, [], 2)]
    table = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int")
    table.withColumn("row", F.lit("clash")).withColumn("g", F.lit(1)).withColumn("tree", F.lit(1)).write.parquet(f"{folder}/embeddings.parquet")
    labels = [(i, i % 2, 0) for i in range(0, 40, 3)] + [(3, 1, 0), (None, 1, 0), (5, None, 0), (99, 1, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def edge_database(folder):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    return db


def test_registration():
    names = {*QUERIES, "pipeline"}
    assert names <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), database(SF), ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql_on_edge_cases(spark, edge_dir, name):
    assert differences(QUERIES[name](spark, edge_dir), edge_database(edge_dir), ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, edge_dir, tmp_path, name):
    for table in TABLES:
        spark.read.parquet(f"{edge_dir}/{table}.parquet").filter("false").write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == (1 if name == "op5_chat" else 0)


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_mix_is_repeatable_without_ids(spark, partitions):
    rows = [(None, f"text {chr(97 + i % 26)} {i:03}", "one") for i in range(60)] + [(4, f"more {i:03}", "two") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(partitions, "text")
    taken = sorted((r.row.text, r.repeats) for r in mixing.mix(docs).collect())
    again = sorted((r.row.text, r.repeats) for r in mixing.mix(docs.repartition(2).orderBy(F.desc("text"))).collect())
    assert taken == again and len({n for _, n in taken}) > 1


def test_repeated_notices_are_all_reported(spark):
    texts = ["all rights reserved " * 4, "all rights reserved", "all rights reserved all rights reserved then text"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    spans = {r.doc_id: [s.first for s in r.spans] for r in licenses.scan(docs).collect()}
    assert spans[1] == [0] and len(spans[0]) == 4 and len(spans[2]) == 2


def test_native_queries_run_no_python(spark):
    for name in ("op3_lines", "op4_licenses", "op5_chat", "op6_imatch", "op7_mixing"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan, name
