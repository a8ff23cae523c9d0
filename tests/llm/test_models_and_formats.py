"""What SQL cannot express: the classifier, tokens, archives; and details of the other operators."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from sentiflow.llm import chat, imatch, lines, mixing, pieces, quality, setsketch, warc
from sentiflow.llm.queries import PIECES_MODEL, QUERIES
from sentiflow.sources import stage

from ..conftest import SF
from .helpers import documents, shingle_set

# Quality


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = QUERIES["op1_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = scored.filter("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    auc = np.mean([[0.5 * (g == b) + (g > b) for b in bad] for g in good])
    assert auc > 0.97 and np.mean(np.array(good) >= 0.3) > 0.97


def test_quality_of_odd_tables(spark):
    docs = documents(spark, ["fine words here", None, "", "BAD!! BAD!! BAD!!", "y" * 200_000, "x"]).withColumn("row", F.lit(1))
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 0), (5, None, 1), (None, 1, 0), (0, 1, 0), (1, 5, 0)], "doc_id bigint, quality int, toxic int")
    for known in (labels, labels.filter("quality = 1"), labels.filter("false")):
        got = quality.classify(docs, known).collect()
        assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.classify(docs, labels.filter("false")).collect()} == {0.5}
    assert quality.good_documents(docs, labels).columns == docs.columns
    assert quality.classify(docs.filter("false"), labels).count() == 0
    known = [r.doc_id for r in spark.range(200).select(F.col("id").alias("doc_id"), quality.held_out("id").alias("h")).filter("h").collect()]
    import zlib

    assert known == [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]


# Tokens


def test_encoding_is_the_library_s(spark):
    rng = random.Random(2)
    alphabet = ["a", "b", " ", "  ", "\n", "\t", "▁", "é", "漢", "🙂", "the", " the", "ing", "...", "=====", "abab", "</s>", "\x00", "ﬁ", "　", "12"]
    texts = [None, "", " ", " " * 100, "a" * 3000, "=" * 333, "▁▁ ▁", "ab" * 2000]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    library = SentencePieceProcessor(model_file=PIECES_MODEL)
    docs = documents(spark, texts).withColumn("ids", F.lit(1)).withColumn("key", F.lit(2))
    rows = pieces.encode(docs, PIECES_MODEL, decoded=True)
    for row in rows.collect():
        expected = library.encode(texts[row.doc_id] or "", add_eos=True)
        assert row.ids == expected and row.decoded == library.decode(expected)
    back = {r.doc_id: r.text for r in pieces.decode(rows, PIECES_MODEL).collect()}
    assert back == {i: library.decode(library.encode(t or "")) for i, t in enumerate(texts)}


def test_forgotten_words_are_merged_again(monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_WORDS", 3)
    monkeypatch.setattr(pieces, "MERGE_CHARS", 5)
    encoder = pieces.Encoder(PIECES_MODEL)
    library = SentencePieceProcessor(model_file=PIECES_MODEL)
    for text in ("some words to forget", "and others", "some words  again"):
        assert encoder.encode([text])[0].tolist() == library.encode(text)


def test_other_models_are_refused():
    with pytest.raises(Exception):
        pieces.Pieces(public_tokenizers.path("byte_bpe_50k.json"))


# Archives


def records_of(data):
    import io

    return [warc.parse_record(x) for x in warc.frames(io.BytesIO(data))]


def record(kind="resource", body=b"hello", length=None, extra="", version="WARC/1.1"):
    head = f"{version}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: {len(body) if length is None else length}\r\n{extra}\r\n"
    return head.encode() + body + b"\r\n\r\n"


def test_frames_with_and_without_dictionary():
    plain = zstandard.ZstdCompressor()
    content = b"WARC/1.1 WARC-Type: resource WARC-Date: 2024-01-01T00:00:00Z " * 3
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packed = zstandard.ZstdCompressor(dict_data=dictionary)
    bodies = [b"", b"x", b"y" * 200_000]
    for front, compress in (
        (b"", plain.compress),
        (struct.pack("<II", 0x184D2A5D, len(content)) + content, packed.compress),
        (struct.pack("<II", 0x184D2A5D, len(plain.compress(content))) + plain.compress(content), packed.compress),
    ):
        data = front + b"".join(compress(record(body=b)) for b in bodies)
        assert [(r["payload"], r["error"]) for r in records_of(data)] == [(b, None) for b in bodies]
        with pytest.raises(ValueError):
            records_of(data[:-3])
    assert records_of(b"") == []


def test_invalid_records_say_why():
    http = b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"
    digest = "WARC-Payload-Digest: sha1:VGMT4NSHA2AWVOR6EVYXQUGCNSONBWE5\r\n"
    assert warc.parse_record(record("response", http, extra=digest))["error"] is None
    wrong = [
        record(version="WARC/9"), b"", record().replace(b"WARC-Date", b"Other"), record(length=4), record(length="x"), record()[:-1],
        record("response", http.replace(b"3", b"4", 1).replace(b"1.1 400", b"1.1 200")),
        record("response", http[:-1] + b"d", extra=digest), record("response", http, extra="WARC-Payload-Digest: sha1:!\r\n"),
        record("revisit", http), record("response", http.replace(b"Length: 3", b"Length: 9")),
    ]
    for data in wrong:
        assert warc.parse_record(data)["error"], data


def test_archives_of_pages(spark, tmp_path, monkeypatch):
    html = [None, "", "é" * 600, "same " * 400, "same " * 400, "tiny", "tiny", "z" * 300_000]
    pages = spark.createDataFrame([(i, f"http://x/{i}", h, "clash") for i, h in enumerate(html)], "page_id bigint, url string, html string, type string")
    repeated = pages.unionByName(pages.filter("page_id = 7")).unionByName(pages.filter("page_id = 2").withColumn("page_id", F.lit(None).cast("bigint")))
    written = warc.write_archives(warc.page_records(repeated), str(tmp_path / "a"), archive_bytes=1500)
    assert written.count() >= 2 and written.agg(F.sum("records")).first()[0] == 10
    for file in (tmp_path / "a").iterdir():
        assert file.read_bytes()[:4] == struct.pack("<I", 0x184D2A5D)
    for archives in (written, warc.archives_in(spark, str(tmp_path / "a"))):
        rows = warc.read_archives(archives).collect()
        assert len(rows) == 10 and not any(r.error for r in rows)
        by_id = {r.record_id: r for r in rows if r.record_id != "7"}
        assert by_id["3"].record_type == "revisit" and by_id["3"].refers_to == "4" and by_id["3"].payload is None
        assert by_id[None].refers_to == "2" and by_id["5"].record_type == by_id["6"].record_type == "response"
        assert by_id["2"].payload.decode() == html[2] and by_id["0"].payload == b""
        assert [r.record_type for r in rows if r.record_id == "7"] == ["response"] * 2
        assert by_id["2"].target_uri == "http://x/2"
    (tmp_path / "a" / "broken.warc.zst").write_bytes(b"not an archive")
    assert sum(bool(r.error) for r in warc.read_archives(warc.archives_in(spark, str(tmp_path / "a"))).collect()) == 1
    every = warc.read_archives(warc.archives_in(spark, str(tmp_path / "a"))).count()
    monkeypatch.setattr(warc, "READ_TASKS", 2)
    few = warc.read_archives(warc.archives_in(spark, str(tmp_path / "a")))
    assert few.rdd.getNumPartitions() == 2 and few.count() == every


# Details of the native operators


def test_examples_train_on_one_reply_each(spark):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "[a]"), (1, 2, "user", "r"), (1, 3, "assistant", "b")]
    rows = chat.examples(spark.createDataFrame(turns, "conv_id int, turn int, role string, text string")).orderBy("turns").collect()
    assert [r.turns for r in rows] == [2, 4]
    assert rows[0].formatted == "<|user|>\nq<|end|><|assistant|>\n\\ba]<|end|>"
    assert [r.formatted[r.mask_start : r.mask_start + r.mask_chars] for r in rows] == ["\\ba]", "b"]
    assert rows[1].formatted.startswith(rows[0].formatted)


def test_ranges_of_the_order(spark):
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randint(0, 30))) for _ in range(200)]
    docs = documents(spark, texts)
    docs = docs.unionByName(docs.filter("doc_id in (3, 77)").withColumn("text", F.lit("tie"))).unionByName(docs.filter("doc_id = 9").withColumn("doc_id", F.lit(None).cast("bigint")))
    one = {tuple(r) for r in imatch.fingerprints(docs, rows_per_range=10**6).collect()}
    many = {tuple(r) for r in imatch.fingerprints(docs, rows_per_range=7).collect()}
    assert one == many and len(one) == 203
    ordered = imatch.in_order(docs, 7).filter("guest = 0").select("doc_id", "next_text").collect()
    nexts = {r.doc_id: r.next_text for r in ordered}
    assert nexts[150] == texts[149] and nexts[None] == texts[199]


def test_equal_texts_have_equal_fingerprints(spark):
    got = QUERIES["op6_imatch"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), "doc_id")
    assert got.groupBy("text").agg(F.count_distinct("fingerprint").alias("n")).filter("n > 1").count() == 0
    assert got.agg(F.avg("near_edited") > F.avg("near_next")).first()[0]


def test_water_filling_by_rounds(spark):
    rng = random.Random(4)
    for n in (1, 3, 40):
        sources = [(f"s{i:03d}", rng.randrange(0, 1000), float((5, 2, 1)[i % 3])) for i in range(n)]
        table = stage(spark.createDataFrame(sources, "source string, source_size bigint, weight double"), "sources")
        got = {r.source: r.target for r in mixing.water_fill(table).collect()}
        total = 1.5 * sum(s for _, s, _ in sources)
        open_, target = list(sources), {}
        while open_:
            level = (total - sum(target.values())) / sum(w for *_, w in open_)
            full = [x for x in open_ if level * x[2] >= 2 * x[1]]
            if not full:
                target |= {name: level * w for name, _, w in open_}
                break
            target |= {name: 2.0 * size for name, size, _ in full}
            open_ = [x for x in open_ if x not in full]
        assert got == pytest.approx(target)


def test_mix_comes_near_its_targets(spark):
    sf = "/root/testdata/sf0.01"
    sources = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source")
    rows = QUERIES["op7_mixing"](spark, sf).join(sources, "doc_id").collect()
    assert all(r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0) for r in rows)
    taken, largest, target = {}, {}, {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)


def test_near_threshold_lines_are_counted(spark):
    docs = documents(spark, ["shared\nown %d" % i for i in range(40)], source=lambda i: f"s{i % 8}")
    kept = {r.doc_id: r.text for r in lines.deduplicated(docs, min_sites=8).collect()}
    assert kept == {i: "shared\nown 0" if i == 0 else f"own {i}" for i in range(40)}
    assert lines.deduplicated(docs, min_sites=9).exceptAll(docs).count() == 0


@pytest.mark.parametrize("doc_id", [None, 7])
def test_lines_of_texts_without_ids_of_their_own(spark, doc_id):
    rows = [(doc_id, f"header\nown {i}", f"s{i % 8}") for i in range(40)]
    docs = spark.createDataFrame(rows + rows[:1], "doc_id bigint, text string, source string")
    cleaned = [(r.row.text, r.text, r.n_removed) for r in lines.without_spread_lines(docs).collect()]
    assert len({before for before, after, _ in cleaned if before == after}) == 1
    assert all(after in (before, before.removeprefix("header\n")) for before, after, _ in cleaned)
    # Smaller ids come first as numbers.
    more = spark.createDataFrame([(10, "header\nten", "s1"), (9, "header\nnine", "s2")], docs.schema)
    kept = lines.deduplicated(docs.filter("doc_id is not null").unionByName(more), min_sites=2)
    assert {r.text for r in kept.filter("doc_id > 8").collect()} == ({"ten", "nine"} if doc_id else {"ten", "header\nnine"})


# The pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before, kept = docs.columns, docs, {}
    for name, apply in corpus_pipeline.STAGES:
        kept[name] = stage(apply(spark, before, SF), name.replace(" ", "-"))
        if name != "encoding":
            assert kept[name].columns == columns
        before = kept[name]
    scores = {r.doc_id: r.predicted for r in QUERIES["op1_quality"](spark, SF).collect()}
    good = {r.doc_id for r in kept["quality classifier"].collect()}
    assert good == {i for i, p in scores.items() if p}
    lined = {r.doc_id: r.text for r in kept["line dedup"].collect()}
    assert set(lined) == good
    sets = {i: shingle_set(t, 5) for i, t in lined.items()}
    stays = {r.doc_id for r in kept["near dedup"].collect()}
    for i in good - stays:
        assert any(100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for j in good if j != i)
    for i in stays:
        assert not any(sets[i] and j < i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for j in stays)
    library = SentencePieceProcessor(model_file=PIECES_MODEL)
    assert kept["mixing"].count() == kept["encoding"].count()
    for row in kept["encoding"].collect():
        assert row.ids == library.encode(lined[row.doc_id], add_eos=True) and row.n_tokens == len(row.ids)


def test_pipeline_decodes_what_it_encodes(spark):
    texts = ["plain words", "İ ẞ 🙂 \n two  spaces", None, ""]
    rows = corpus_pipeline.encode(spark, documents(spark, texts), SF).collect()
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(texts)}
