"""CSV read in ranges against the reader that takes a file in one task."""

import random

import pytest

from sentiflow.sources import read_reviews_csv
from sentiflow.sources.csv_ranges import ends_inside

HEADER = "Product Name,Brand Name,Price,Rating,Reviews"


@pytest.fixture
def small_ranges(spark):
    """A session that cuts files to ranges of a few bytes."""

    def of(size):
        session = spark.newSession()
        for key, value in {"maxPartitionBytes": size, "openCostInBytes": 1, "minPartitionNum": 1}.items():
            session.conf.set(f"spark.sql.files.{key}", str(value))
        return session

    return of


def rows(table):
    return sorted((tuple(r) for r in table.collect()), key=repr)


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def wild_file(rng, records, end="\n"):
    """Quoted line breaks, doubled quotes, separators in quotes, empty fields, quotes in the middle."""
    bits = ["a", "word ", ",", end, '"', '""', f'{end}"{end}', f'",{end}', "é語🙂", " ", f"{end}{end}"]
    lines = [HEADER]
    for n in range(records):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        review = rng.choice([quoted(text), quoted(text), "plain", "", '5" screen', quoted("")])
        lines.append(f"p{n},{rng.choice(['', 'b', quoted('b,b')])},1.5,{n % 7},{review}")
    return end.join(lines) + rng.choice(["", end])


@pytest.mark.parametrize("size", [30, 300, 100_000])
def test_ranges_equal_one_task(spark, small_ranges, tmp_path, size):
    rng = random.Random(size)
    for n, records in enumerate([0, 1, 40]):
        (tmp_path / f"{n}.csv").write_bytes(wild_file(rng, records).encode())
    session = small_ranges(size)
    split = read_reviews_csv(session, str(tmp_path), split=True)
    assert rows(split) == rows(read_reviews_csv(spark, str(tmp_path)))


def test_windows_line_ends(spark, small_ranges, tmp_path):
    (tmp_path / "a.csv").write_bytes(wild_file(random.Random(4), 30, "\r\n").encode())
    assert rows(read_reviews_csv(small_ranges(60), str(tmp_path), split=True)) == rows(read_reviews_csv(spark, str(tmp_path)))


def test_a_record_over_many_ranges_and_an_unclosed_one(spark, small_ranges, tmp_path):
    long = quoted("line\n" * 100 + 'a "quoted" one\n' + ",\n" * 100)
    (tmp_path / "a.csv").write_text(f'{HEADER}\np,b,1,5,{long}\nq,b,2,4,short\nr,b,3,3,"never\nclosed\n')
    session = small_ranges(40)
    split = read_reviews_csv(session, str(tmp_path), split=True)
    assert {r["Product Name"]: len(r["Reviews"]) for r in split.collect()} == {"p": 715, "q": 5, "r": 12}


def test_a_large_file_is_read_by_several_tasks(spark, small_ranges, tmp_path):
    (tmp_path / "a.csv").write_text(wild_file(random.Random(1), 2000))
    scan = small_ranges(10_000).read.option("lineSep", "\n").text(str(tmp_path))
    assert scan.rdd.getNumPartitions() > 4
    split = read_reviews_csv(small_ranges(10_000), str(tmp_path), split=True)
    assert split.rdd.getNumPartitions() > 4


def test_malformed_rows_are_kept(spark, small_ranges, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\np,b,cheap,5,text\nq,b\nr,b,1,5,fine\n")
    found = read_reviews_csv(small_ranges(20), str(tmp_path), split=True).collect()
    assert {r["Product Name"]: r["_corrupt_record"] for r in found} == {"p": "p,b,cheap,5,text", "q": "q,b", "r": None}


def test_another_header_fails(spark, small_ranges, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\np,b,1,5,x\n")
    (tmp_path / "b.csv").write_text("Brand Name,Product Name,Price,Rating,Reviews\nb,p,1,5,x\n")
    with pytest.raises(Exception, match="header is not"):
        read_reviews_csv(small_ranges(1000), str(tmp_path), split=True).collect()


@pytest.mark.parametrize(
    "line, clear, inside",
    [
        ("a,b", False, True), ('"a', True, False), ('a"b', False, False), ('"a","b', True, True),
        ('"a""', True, False), ('a""', False, True), ('"",""', False, True), ('x","y', True, True), ('"a"b"c', False, False),
    ],
)
def test_state_at_the_end_of_a_line(line, clear, inside):
    assert (ends_inside(line, False), ends_inside(line, True)) == (clear, inside)
