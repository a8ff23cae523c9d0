"""WARC archives compressed with Zstandard: one frame per record, and a dictionary in front.

An archive begins with a skippable frame that holds the dictionary its records are compressed with.
Every record is a frame of its own, so archives are read record by record in bounded memory.

Tasks write whole archives under new names and return a row for each; Spark commits these rows, and
only archives with a committed row are read. What a lost or repeated task leaves behind plays no
part. Archives are written and read through Arrow's file systems, which take local paths as well as
the usual cluster stores.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lookup import lookup
from ..sources.storage import scratch_path, stage

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = b"\x28\xb5\x2f\xfd"
VERSIONS = ("WARC/1.0", "WARC/1.1")
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads below this are never written as revisits.
MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 * 1024 * 1024
DICTIONARY_BYTES = 16 * 1024
#: A task trains its dictionary on its first records, up to this many bytes of them.
SAMPLE_BYTES = 512 * 1024
READ_BYTES = 16 * 1024
ROWS_OUT = 256
#: Tasks that archives are read in, at most; a task reads its archives as streams.
READ_TASKS = 20_000

WRITTEN = "path string, records bigint, bytes bigint"
READ = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_bytes bigint, payload_digest string, payload binary, error string"
)
_READ_ARROW = pa.schema(
    [(n, pa.string()) for n in ("record_id", "record_type", "target_uri", "refers_to")]
    + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string())]
)


def page_records(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """What to write for each row of ``pages`` (``page_id``, ``url``, ``html``).

    The payload is ``html`` in UTF-8, empty for null. Among equal payloads of at least
    ``min_revisit_bytes`` the row with the largest ``page_id`` is the response (all of them, should it
    occur repeatedly) and the others are revisits of it without payload. A null ``page_id`` counts as
    the smallest. Other columns are ignored.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.sha1(payload).alias("digest"),
    )
    large = rows.filter(F.col("payload_bytes") >= min_revisit_bytes)
    repeated = large.groupBy("digest").agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n"))
    repeated = stage(repeated.filter("n > 1").select("digest", "newest"), "warc-repeated")
    revisit = F.coalesce(F.col("page_id") < F.col("newest"), F.col("page_id").isNull() & F.col("newest").isNotNull())
    return lookup(rows, repeated, "digest", "left").select(
        F.col("page_id").cast("string").alias("record"),
        F.when(revisit, "revisit").otherwise("response").alias("type"),
        F.when(revisit, F.col("newest").cast("string")).alias("refers_to"),
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "payload_bytes",
        "digest",
    )


def _uri(url: str) -> str:
    """A header value has no control characters: those are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda c: f"%{ord(c[0]):02X}", url)


def _record(row: dict) -> bytes:
    payload = row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    block = http.encode() + payload
    headers = [
        ("WARC-Type", row["type"]),
        ("WARC-Record-ID", f"<urn:page:{row['record'] or ''}>"),
        ("WARC-Date", "2024-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode()),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if row["url"] is not None:
        headers.append(("WARC-Target-URI", _uri(row["url"])))
    if row["type"] == "revisit":
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{row['refers_to']}>")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; with too few of them to train on, their bytes themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        start = b"".join(samples)[:DICTIONARY_BYTES].ljust(64)
        return zstandard.ZstdCompressionDict(start, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _write_task(batches: Iterable[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    records = (_record(row) for batch in batches for i in range(0, len(batch), 64) for row in batch.slice(i, 64).to_pylist())
    samples, size = [], 0
    for record in records:
        samples.append(record)
        size += len(record)
        if size >= SAMPLE_BYTES:
            break
    if not samples:
        return
    dictionary = _dictionary(samples)
    front = struct.pack("<II", DICTIONARY_FRAME, len(dictionary.as_bytes())) + dictionary.as_bytes()
    compress = zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=True).compress

    def waiting() -> Iterator[bytes]:
        yield from samples
        samples.clear()
        yield from records

    rest = waiting()
    record = next(rest, None)
    while record is not None:
        name = f"{uuid.uuid4().hex}.warc.zst"
        n, written = 0, len(front)
        # Without this Arrow would compress the archive once more, by its name.
        with store.open_output_stream(f"{base}/{name}", compression=None) as out:
            out.write(front)
            while record is not None and (n == 0 or written < archive_bytes):
                frame = compress(record)
                out.write(frame)
                n, written = n + 1, written + len(frame)
                record = next(rest, None)
        yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [n], "bytes": [written]})


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of ``page_records`` as archives into ``folder``: one row per archive.

    A task starts a new archive when one has reached ``archive_bytes``; each has one record at least,
    however small that is. No rows: no archives.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _write_task(batches, folder, archive_bytes)

    return stage(records.mapInArrow(task, WRITTEN), "warc-archives")


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` of all archives in a folder, listed by Spark."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", True)
    return files.load(folder).select("path")


def _take(stream, n: int) -> bytes:
    parts = []
    while n > 0 and (part := stream.read(n)):
        parts.append(part)
        n -= len(part)
    return b"".join(parts)


def frames(stream) -> Iterator[bytes]:
    """The content of each frame, decompressed with the dictionary in front if there is one."""
    pending, dictionary = _take(stream, 8), None
    if len(pending) == 8 and struct.unpack("<I", pending[:4])[0] == DICTIONARY_FRAME:
        length = struct.unpack("<I", pending[4:])[0]
        content, pending = _take(stream, length), b""
        if len(content) < length:
            raise ValueError("archive ends inside its dictionary")
        if content.startswith(ZSTD_FRAME):
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        dictionary = zstandard.ZstdCompressionDict(content)
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while pending := pending or stream.read(READ_BYTES):
        frame, parts = decompressor.decompressobj(), []
        while True:
            parts.append(frame.decompress(pending))
            if frame.eof:
                break
            if not (pending := stream.read(READ_BYTES)):
                raise ValueError("archive ends inside a record")
        pending = frame.unused_data
        yield b"".join(parts)


def _headers(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _page(value: str | None) -> str | None:
    found = re.fullmatch(r"<(?:urn:page:)?(.*)>", value or "")
    return (found[1] or None) if found else value


def parse_record(data: bytes) -> dict:
    """Fields of one record. ``error`` says what is wrong with it; it is null for a valid record."""
    out = dict.fromkeys(_READ_ARROW.names)
    head, blank, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    headers = _headers(lines)
    out |= {
        "record_id": _page(headers.get("warc-record-id")),
        "record_type": headers.get("warc-type"),
        "target_uri": headers.get("warc-target-uri"),
        "refers_to": _page(headers.get("warc-refers-to")),
    }
    if version.decode("latin-1") not in VERSIONS or not blank:
        return out | {"error": "no WARC header"}
    if missing := [name for name in REQUIRED if not headers.get(name)]:
        return out | {"error": f"without {', '.join(missing)}"}
    length = headers["content-length"]
    if not re.fullmatch("[0-9]+", length) or len(rest) != int(length) + 4 or not rest.endswith(b"\r\n\r\n"):
        return out | {"error": f"block of {len(rest) - 4} bytes, Content-Length {length}"}
    block = rest[:-4]
    if headers["warc-type"] not in ("response", "revisit") or not block.startswith(b"HTTP/"):
        return out | {"payload": block, "payload_bytes": len(block), "payload_digest": hashlib.sha1(block).hexdigest()}
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = _headers(http.split(b"\r\n")[1:]).get("content-length", "")
    size = int(declared) if re.fullmatch("[0-9]+", declared) else None
    try:
        digest = base64.b32decode(headers.get("warc-payload-digest", "").removeprefix("sha1:")).hex()
    except ValueError:
        return out | {"error": "unreadable payload digest"}
    if headers["warc-type"] == "revisit":
        found = {"payload_bytes": size, "payload_digest": digest}
        if payload or not headers.get("warc-refers-to") or len(digest) != 40 or size is None:
            found["error"] = "revisit with payload, or without reference, length or digest"
        return out | found
    out |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": hashlib.sha1(payload).hexdigest()}
    if size is not None and size != len(payload):
        out["error"] = f"payload of {len(payload)} bytes, HTTP Content-Length {size}"
    elif digest and digest != out["payload_digest"]:
        out["error"] = "payload differs from its digest"
    return out


def _read_task(batches: Iterable[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    rows: list[dict] = []
    size = 0
    for path in (p for batch in batches for p in batch.column(0).to_pylist()):
        store, name = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
        with store.open_input_stream(name, compression=None) as stream:
            try:
                for data in frames(stream):
                    row = parse_record(data)
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    size += len(row["payload"] or b"")
                    if len(rows) >= ROWS_OUT or size >= 8 * 1024 * 1024:
                        yield pa.RecordBatch.from_pylist(rows, _READ_ARROW)
                        rows, size = [], 0
            except (ValueError, zstandard.ZstdError) as e:
                rows.append(dict.fromkeys(_READ_ARROW.names) | {"error": f"{path}: {e}"})
    if rows:
        yield pa.RecordBatch.from_pylist(rows, _READ_ARROW)


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the archives at ``path``.

    Invalid records are kept, with ``error`` saying why; an archive that breaks off adds a row with
    an error and no record. ``payloads=False`` checks payloads but leaves them out of the rows. A task
    reads one archive, or several one after the other where there are more than ``READ_TASKS``.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _read_task(batches, payloads)

    paths = archives.select("path")
    return paths.repartition(max(1, min(READ_TASKS, paths.count()))).mapInArrow(task, READ)


def archived_pages(pages: DataFrame, payloads: bool = True) -> DataFrame:
    """Write pages as archives into the shared folder and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(page_records(pages), folder), payloads)
