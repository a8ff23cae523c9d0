import pytest
from pyspark.sql import functions as F

from sentiflow.operators import clean_reviews, with_hash_split
from sentiflow.sources import (
    CORRUPT,
    class_dim,
    corrupt_rows,
    ingest_reviews_csv,
    read_reviews,
    read_reviews_csv,
    shared_dir,
    stage,
    with_content_key,
)

CSV = '''Product Name,Brand Name,Price,Rating,Reviews,Review Votes
P1,B1,10.5,5,"A ""smart"" phone, really",1
P2,B2,20.0,1,"Broke after
two days",0
P3,B3,30.0,,no rating here,0
P4,B4,40.0,4,,0
P5,B5,50.0,7,rated out of range,0
P6,B6,60.0,abc,rated by a word,0
P7,B7,70.0,5,ok,0
P8,B8,cheap,3,price is a word,0
P9,B9
P10,B10,80.0,2,!!! 123,0
'''


@pytest.fixture
def csv_path(tmp_path):
    (tmp_path / "reviews.csv").write_text(CSV, encoding="utf-8")
    return str(tmp_path / "reviews.csv")


def test_csv_scan(spark, csv_path):
    rows = {r["Product Name"]: r for r in read_reviews_csv(spark, csv_path).collect()}
    assert len(rows) == 10
    assert rows["P1"]["Reviews"] == 'A "smart" phone, really'
    assert rows["P2"]["Reviews"] == "Broke after\ntwo days"
    assert rows["P3"]["Rating"] is None and rows["P4"]["Reviews"] is None
    assert rows["P8"]["Price"] is None and rows["P8"]["Reviews"] == "price is a word"
    assert "Review Votes" not in rows["P1"].asDict()


def test_csv_cleaning(spark, csv_path):
    kept = clean_reviews(read_reviews_csv(spark, csv_path)).collect()
    assert {r["Product Name"]: r.label for r in kept} == {"P1": 2.0, "P2": 0.0, "P8": 1.0}


def test_ingest_keeps_rejects_and_adds_a_stable_key(spark, csv_path, tmp_path):
    table = ingest_reviews_csv(spark, csv_path, str(tmp_path / "table"))
    assert sorted(r["Product Name"] for r in corrupt_rows(table).collect()) == ["P8", "P9"]
    again = read_reviews(spark, str(tmp_path / "table")).repartition(3)
    keys = {r["Product Name"]: r.review_id for r in table.collect()}
    assert len(set(keys.values())) == 10
    assert keys == {r["Product Name"]: r.review_id for r in again.collect()}


def test_keys_and_splits_are_the_same_after_another_ingest(spark, csv_path, tmp_path):
    one = ingest_reviews_csv(spark, csv_path, str(tmp_path / "one"))
    read_reviews_csv(spark, csv_path).drop(CORRUPT).repartition(4).write.csv(
        str(tmp_path / "parts"), header=True, escape='"'
    )
    two = ingest_reviews_csv(spark, str(tmp_path / "parts"), str(tmp_path / "two"))

    def split(table):
        return {r["Product Name"]: (r.review_id, r.split) for r in with_hash_split(table).collect()}

    # A malformed price is lost in the copy, so that row's content is another; none of the rest changes.
    first, second = split(one), split(two)
    assert first == second
    assert first == split(ingest_reviews_csv(spark, csv_path, str(tmp_path / "three")))


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Reviews,Rating,Price,Brand Name,Product Name\ngood phone,5,1.5,B,P\n")
    row = read_reviews_csv(spark, str(tmp_path / "r.csv")).first()
    assert (row["Reviews"], row["Rating"], row["Price"], row["Product Name"]) == ("good phone", "5", 1.5, "P")
    (tmp_path / "bad.csv").write_text("Reviews,Stars\ngood,5\n")
    with pytest.raises(ValueError, match="Rating"):
        read_reviews_csv(spark, str(tmp_path / "bad.csv"))


def test_content_key(spark, csv_path):
    rows = with_content_key(read_reviews_csv(spark, csv_path))
    assert rows.select("review_id").distinct().count() == 10


def test_failfast_mode(spark, csv_path):
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        read_reviews_csv(spark, csv_path, mode="FAILFAST").collect()


def test_class_dimension(spark):
    assert [tuple(r) for r in class_dim(spark).orderBy("position").collect()] == [
        (0.0, "Negative", 0),
        (1.0, "Neutral", 1),
        (2.0, "Positive", 2),
    ]


def test_stage_is_in_the_shared_folder_and_cuts_lineage(spark):
    staged = stage(spark.range(10).select(F.col("id"), (F.col("id") * 2).alias("x")), "t")
    assert all(shared_dir(spark) in f for f in staged.inputFiles())
    assert staged.agg(F.sum("x")).first()[0] == 90
