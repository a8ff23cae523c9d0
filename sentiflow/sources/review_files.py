"""Folders of review CSV in which some files cannot be read.

One scan of a folder takes the column order of one file for all, and a single broken file ends the job.
Here every file is looked through first, in tasks: its header, its encoding, and whether it can be read
to its end. Files that agree are read together; the others are listed with a reason.
"""

from __future__ import annotations

import bz2
import csv
import gzip
import io
from collections.abc import Iterable, Iterator
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .reviews import REVIEW_COLUMNS, read_reviews, read_reviews_csv, with_content_key
from .storage import stage

CHECKED = "path string, length bigint, encoding string, columns array<string>, reason string"
_ARROW = pa.schema(
    [("path", pa.string()), ("length", pa.int64()), ("encoding", pa.string()), ("columns", pa.list_(pa.string())), ("reason", pa.string())]
)
_CHUNK = 1 << 20
_UNPACKED = {".gz": gzip.open, ".bz2": bz2.open}
_PACKED_OTHERWISE = (".deflate", ".lz4", ".snappy", ".zst", ".xz", ".zip")


def _open(path: str) -> io.RawIOBase:
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pyarrow.fs.LocalFileSystem().open_input_stream("/" + rest.lstrip("/"), compression=None)
    system, inside = pyarrow.fs.FileSystem.from_uri(quote(path, safe=":/@"))
    return system.open_input_stream(inside, compression=None)


def _check(path: str, needed: list[str]) -> tuple[str | None, list[str] | None, str | None]:
    """Encoding, columns and, where the file cannot be used, the reason. Holds a megabyte at a time."""
    packed = [suffix for suffix in _PACKED_OTHERWISE if path.endswith(suffix)]
    if packed:
        return None, None, f"compression {packed[0]} is not read"
    encoding = columns = None
    try:
        with _open(path) as file:
            unpack = [kind for suffix, kind in _UNPACKED.items() if path.endswith(suffix)]
            stream = io.BufferedReader(unpack[0](file) if unpack else file, _CHUNK)
            start = stream.peek(3)[:3]
            if not start:
                return None, None, "empty file"
            wide = start[:2] in (b"\xff\xfe", b"\xfe\xff")
            encoding = "UTF-16" if wide else "UTF-8"
            marked = start == b"\xef\xbb\xbf"
            text = io.TextIOWrapper(stream, "utf-16" if wide else "utf-8-sig" if marked else "utf-8", newline="")
            columns = next(csv.reader(text), [])
            while text.read(_CHUNK):
                pass
    except UnicodeDecodeError:
        return encoding, columns, f"not {encoding} text"
    except EOFError:
        return encoding, columns, "compressed file ends early"
    except csv.Error as error:
        return encoding, None, f"header: {error}"
    except OSError as error:
        return encoding, columns, f"cannot be read: {type(error).__name__}"
    except Exception as error:  # zlib has errors of its own; whatever it is, the file is listed with it
        return encoding, columns, f"cannot be read: {type(error).__name__}"
    missing = [c for c in needed if c not in columns]
    if missing:
        return encoding, columns, f"no column {missing[0]}"
    if len(set(columns)) < len(columns):
        return encoding, columns, "a column occurs twice"
    return encoding, columns, None


def _check_task(batches: Iterable[pa.RecordBatch], needed: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
            encoding, columns, reason = _check(path, needed)
            rows.append({"path": path, "length": length, "encoding": encoding, "columns": columns, "reason": reason})
        yield pa.RecordBatch.from_pylist(rows, _ARROW)


def check_review_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file: ``path``, ``length``, ``encoding``, ``columns`` in the file's order, and
    ``reason``, null where all of the file can be read. A file without a single byte is in no scan of
    Spark's and not listed.

    Text is UTF-8, or UTF-16 with its mark. Gzip and bzip2 are unpacked. Each file is read once from
    one end to the other in a task, in pieces of a megabyte; Spark deals files out by their sizes.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    needed = list(REVIEW_COLUMNS)
    return files.mapInArrow(lambda batches: _check_task(batches, needed), CHECKED)


def read_review_files(spark: SparkSession, path: str | list[str], **options) -> tuple[DataFrame, DataFrame]:
    """``(reviews, quarantined)``: the rows of all files that can be read, and the files that cannot.

    Files of one encoding and column order are one scan (``read_reviews_csv`` with ``options``), found
    by the name of the column. ``review_id`` is null in rows of files without it, where others have it.
    The list of files and of their headers passes through the driver, as Spark's own listing does.
    """
    checked = stage(check_review_files(spark, path), "checked-files")
    good = checked.filter(F.col("reason").isNull())
    groups = good.groupBy("encoding", "columns").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    # Files split into ranges are taken as UTF-8.
    tables = [
        read_reviews_csv(spark, g.paths, encoding=g.encoding, **options | ({"split": False} if g.encoding != "UTF-8" else {}))
        for g in groups.orderBy("encoding", "columns").collect()
    ]
    if not tables:
        kinds = ", ".join(f"`{c}` {'double' if c == 'Price' else 'string'}" for c in REVIEW_COLUMNS)
        tables = [spark.createDataFrame([], f"{kinds}, _corrupt_record string")]
    reviews = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return reviews, checked.filter(F.col("reason").isNotNull())


def ingest_review_files(
    spark: SparkSession, path: str | list[str], table_path: str, **options
) -> tuple[DataFrame, DataFrame]:
    """``ingest_reviews_csv`` for such folders: ``(table, quarantined)``. Rows without ``review_id`` get
    it from their content, whatever file they are in."""
    reviews, quarantined = read_review_files(spark, path, **options)
    given = F.col("review_id") if "review_id" in reviews.columns else F.lit(None).cast("string")
    keyed = with_content_key(reviews.withColumn("_given", given).drop("review_id"))
    keyed = keyed.withColumn("review_id", F.coalesce("_given", "review_id")).drop("_given")
    keyed.write.mode("overwrite").parquet(table_path)
    return read_reviews(spark, table_path), quarantined
