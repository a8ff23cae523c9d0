"""Folders with files that cannot be read."""

import bz2
import gzip

import pytest
from sentiflow.operators import clean_reviews
from sentiflow.sources import check_review_files, ingest_review_files, read_review_files

HEADER = "Product Name,Brand Name,Price,Rating,Reviews\n"


def lines(name, n=3):
    return "".join(f'{name}{i},b,{i}.5,{1 + i % 5},"café ""{name}""\nsecond line {i}"\n' for i in range(n))


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "in put"
    d.mkdir()
    (d / "plain.csv").write_text(HEADER + lines("plain"), encoding="utf-8")
    (d / "marked.csv").write_text(HEADER + lines("marked"), encoding="utf-8-sig")
    other = "".join(f'5,"text of other\n{i}",other{i},2.0,b\n' for i in range(4))
    (d / "other.csv").write_text("Rating,Reviews,Product Name,Price,Brand Name\n" + other)
    (d / "wide.csv").write_text(HEADER + lines("wide"), encoding="utf-16")
    (d / "keyed.csv").write_text("review_id," + HEADER + "k1,keyed0,b,1.0,4,text\n")
    whole = gzip.compress((HEADER + lines("packed", 400)).encode())
    (d / "packed.csv.gz").write_bytes(whole)
    (d / "packed.csv.bz2").write_bytes(bz2.compress((HEADER + lines("other-packed")).encode()))
    (d / "bad-cut.csv.gz").write_bytes(whole[: len(whole) // 2])
    (d / "bad-named.csv.gz").write_text(HEADER + lines("named"))
    damaged = bytearray(whole)
    damaged[len(whole) // 2] ^= 255
    (d / "bad-damaged.csv.gz").write_bytes(bytes(damaged))
    (d / "bad-latin.csv").write_text(HEADER + lines("latin"), encoding="latin-1")
    (d / "bad-late.csv").write_bytes((HEADER + lines("late", 60_000)).encode() + b"\xff\xfe\n")
    (d / "no-bytes.csv").write_text("")
    (d / "bad-empty.csv.gz").write_bytes(gzip.compress(b""))
    (d / "bad-columns.csv").write_text("Reviews,Rating\nx,5\n")
    (d / "bad-twice.csv").write_text(HEADER.strip() + ",Rating\np,b,1,5,x,4\n")
    (d / "bad-open.csv").write_text('"' + "x" * 200_000)
    (d / "bad-other.csv.zst").write_bytes(b"?")
    return d


def test_good_rows_are_read_and_bad_files_listed(spark, folder):
    reviews, quarantined = read_review_files(spark, str(folder))
    reasons = {r.path.rsplit("/", 1)[1].split(".")[0]: r.reason for r in quarantined.collect()}
    assert reasons.pop("bad-damaged").split(":")[0] in ("cannot be read", "compressed file ends early", "not UTF-8 text")
    assert reasons == {
        "bad-cut": "compressed file ends early",
        "bad-named": "cannot be read: BadGzipFile",
        "bad-latin": "not UTF-8 text",
        "bad-late": "not UTF-8 text",
        "bad-empty": "empty file",
        "bad-columns": "no column Product Name",
        "bad-twice": "a column occurs twice",
        "bad-open": "header: field larger than field limit (131072)",
        "bad-other": "compression .zst is not read",
    }
    rows = {r["Product Name"]: r for r in reviews.collect()}
    counts = {"plain": 3, "marked": 3, "other": 4, "wide": 3, "keyed": 1, "packed": 400, "other-packed": 3}
    assert set(rows) == {f"{name}{i}" for name, n in counts.items() for i in range(n)} and reviews.count() == sum(counts.values())
    for name in ("plain", "marked", "wide", "packed", "other-packed"):
        row = rows[f"{name}2"]
        assert (row["Reviews"], row["Rating"], row["Price"]) == (f'café "{name}"\nsecond line 2', "3", 2.5)
    assert rows["other1"]["Reviews"] == "text of other\n1" and rows["other1"]["Price"] == 2.0
    assert rows["keyed0"]["review_id"] == "k1" and rows["plain0"]["review_id"] is None
    assert all(r["_corrupt_record"] is None for r in rows.values())


def test_ranges_and_single_lines(spark, folder):
    columns = ["Product Name", "Reviews", "Rating", "Price"]
    whole = read_review_files(spark, str(folder))[0].select(*columns)
    ranges = read_review_files(spark, str(folder), split=True)[0].select(*columns)
    assert ranges.exceptAll(whole).count() == 0 == whole.exceptAll(ranges).count()


def test_ingestion_keeps_keys_and_gives_the_others(spark, folder, tmp_path):
    table, quarantined = ingest_review_files(spark, str(folder), str(tmp_path / "table"))
    assert quarantined.count() == 10 and table.count() == 417
    ids = [r.review_id for r in table.select("review_id").collect()]
    assert None not in ids and len(set(ids)) == 417 and "k1" in ids
    assert clean_reviews(table).count() > 400


def test_nothing_but_bad_files(spark, tmp_path):
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b""))
    reviews, quarantined = read_review_files(spark, str(tmp_path))
    assert reviews.count() == 0 and quarantined.count() == 1 and clean_reviews(reviews).count() == 0
    checked = check_review_files(spark, str(tmp_path)).first()
    assert checked.length > 0 and checked.columns is None and checked.reason == "empty file"
