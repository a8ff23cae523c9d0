"""Counts taken while writing, sets published at once, typed documents."""

import pytest
from pyspark.sql import functions as F

from checks import tables
from sentiflow.operators import REQUESTS, clean_reviews, observed_cleaning, observed_requests, observed_row, review_funnel
from sentiflow.plans import analyse
from sentiflow.sinks import from_variant_documents, publish, published_run, read_published, to_variant_documents
from sentiflow.sources import names_in, stage

from .conftest import SF, plan_of


def test_the_funnel_is_counted_by_the_write(spark):
    reviews = stage(tables.reviews(spark, SF), "raw")
    rows, counts = observed_cleaning(reviews)
    assert plan_of(rows).count("FileScan") == 1 and "Exchange" not in plan_of(rows)
    spark.sparkContext.setJobGroup("observed", "")
    try:
        written = stage(rows, "cleaned")
        funnel = observed_row(spark, counts)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("observed")) == 1
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert funnel.collect() == review_funnel(reviews).collect()
    assert written.exceptAll(clean_reviews(reviews)).count() == 0 == clean_reviews(reviews).exceptAll(written).count()
    assert analyse(reviews).funnel.collect() == funnel.collect()


def test_counts_of_no_rows_and_of_nulls(spark):
    schema = "review_id bigint, Reviews string, Rating string, `Product Name` string, `Brand Name` string, Price double"
    odd = [(1, None, "5", None, None, None), (2, "long enough to stay", None, None, None, None), (3, "x", "4", None, None, None), (4, "long enough to stay", "4.0", None, None, None), (5, "", "nine", None, None, None)]
    for data in ([], odd):
        reviews = spark.createDataFrame(data, schema)
        rows, counts = observed_cleaning(reviews)
        assert sorted(r.review_id for r in rows.collect()) == [i for i in (4,) if data]
        assert observed_row(spark, counts).collect() == review_funnel(reviews).collect()


def test_requests_are_counted_by_the_write(spark):
    requests = stage(tables.requests(spark, SF), "requests")
    rows, counts = observed_requests(requests)
    written = stage(rows, "told")
    row = observed_row(spark, counts, REQUESTS).first()
    assert row.scored == written.filter("error IS NULL").count() > 0
    assert row.rejected == written.filter("error IS NOT NULL").count() > 0
    assert row.scored + row.rejected == requests.count()


def _run(spark, n):
    one = spark.range(n).select(F.lit(n).alias("run"), "id")
    return {"a": one, "b": one.withColumn("x", F.lit('p,"q"'))}


def _values(published):
    return {name: sorted(map(tuple, t.collect())) for name, t in published.items()}


def test_a_set_is_published_at_once(spark, tmp_path):
    out = str(tmp_path / "out")
    assert read_published(spark, out) == {} and published_run(spark, out) is None
    publish(_run(spark, 2), out, "r1", latest=True)
    first = _values(read_published(spark, out))
    assert first == {"a": [(2, 0), (2, 1)], "b": [(2, 0, 'p,"q"'), (2, 1, 'p,"q"')]}
    broken = _run(spark, 3)
    broken["b"] = broken["b"].withColumn("x", F.when(F.col("id") == 1, F.raise_error(F.lit("lost"))))
    for run_id in ("r1", "r2"):  # the same run again, and another one
        with pytest.raises(Exception, match="lost"):
            publish(broken, out, run_id, latest=True)
        assert _values(read_published(spark, out)) == first and published_run(spark, out) == "r1"
        for name in ("a", "b"):
            for path in (f"{out}/latest/{name}", f"{out}/{name}/run_id=r1"):
                assert spark.read.csv(path, header=True).select("run").distinct().collect() == [("2",)]
    reading = read_published(spark, out)["a"]
    paths = publish(_run(spark, 4), out, "r3", latest=True)
    assert published_run(spark, out) == "r3" and reading.count() == 2
    assert spark.read.csv(paths["b"], header=True).count() == 4 == spark.read.csv(f"{out}/latest/b", header=True).count()
    publish({"a": _run(spark, 5)["a"]}, out, "r4", latest=True, keep=1)
    assert set(read_published(spark, out)) == {"a"} and names_in(spark, f"{out}/latest") == ["a"]
    assert len(names_in(spark, f"{out}/sets")) == 1  # the failed ones went too
    with pytest.raises(ValueError, match="names in use"):
        publish({"latest": _run(spark, 1)["a"]}, out, "r5")


def test_typed_documents(spark):
    rows = spark.sql("""SELECT * FROM VALUES
        (1L, 'x`y', 1.5D, DATE'2024-02-03', ARRAY(1, 2), NAMED_STRUCT('in ner', 'v'), NULL),
        (2L, NULL, NULL, NULL, NULL, NULL, NULL) AS t(id, `it's "a` , price, day, many, nested, never)""")
    documents = stage(to_variant_documents(rows), "documents")
    back = from_variant_documents(documents)
    kinds = dict(back.dtypes)
    assert kinds["id"] == "bigint" and kinds["price"] == "double" and kinds["day"] == "date" and kinds["never"] == "string"
    assert kinds["nested"] == "struct<in ner:string>"
    columns = [F.col("`" + c + "`") for c in rows.columns]
    assert sorted(map(str, back.select(*columns).collect())) == sorted(map(str, rows.collect()))
    mixed = documents.unionByName(to_variant_documents(spark.sql("SELECT 'three' AS id, true AS more")))
    third = from_variant_documents(mixed).filter("more").select(F.variant_get("id", "$", "string"), "price").first()
    assert tuple(third) == ("three", None)
    declared = from_variant_documents(mixed, spark.createDataFrame([], "id bigint, none int").schema)
    assert sorted(declared.collect(), key=str) == sorted([(1, None), (2, None), (None, None)], key=str)
    assert from_variant_documents(documents.limit(0)).columns == []
    with pytest.raises(ValueError, match="repeated"):
        to_variant_documents(rows.select("id", "id"))
