"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    covertree,
    crosspolytope,
    imatch,
    licenses,
    lines,
    mixing,
    pieces,
    quality,
    setsketch,
    spelling,
    tokencounts,
    warc,
)
from .common import read


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back; an invalid record fails the query."""
    records = warc.archived_pages(read(spark, sf_dir, "pages"), payloads=False)
    valid = F.when(F.col("error").isNull(), F.col("record_id")).otherwise(F.raise_error(F.col("error")))
    return records.select(
        valid.cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


OP2_SQL = """
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
newest AS (
  SELECT payload_digest, max(page_id) AS newest FROM sized WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS DISTINCT FROM newest AND newest IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM newest THEN newest END AS refers_to
FROM sized LEFT JOIN newest USING (payload_digest)
"""


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.without_spread_lines(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return cleaned.select("row.doc_id", "n_lines", "n_removed", "text")


OP3_SQL = """
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS w,
         ('0x' || substr(md5(text), 1, 15))::BIGINT AS hash
  FROM documents),
line AS (
  SELECT r, source, i - 1 AS place, w[i] AS line, trim(w[i], ' ') AS plain,
         -- Rows without an id come first.
         struct_pack(known := doc_id IS NOT NULL, id := coalesce(doc_id, 0), hash := hash, place := i - 1) AS occurrence
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM doc)),
spread AS (
  SELECT plain, min(occurrence) AS first FROM line
  WHERE plain <> '' GROUP BY plain HAVING count(DISTINCT source) >= 8),
kept AS (
  SELECT r, string_agg(line, chr(10) ORDER BY place) FILTER (NOT removed) AS text, count(*) AS n_lines,
         count(*) FILTER (removed) AS n_removed
  FROM (SELECT l.*, first IS NOT NULL AND first <> occurrence AS removed
        FROM line l LEFT JOIN spread USING (plain)) GROUP BY r)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN doc.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
FROM doc LEFT JOIN kept USING (r)
"""


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents")).drop("spans")


def _template_rows() -> str:
    listed = [(*x, True) for x in licenses.PHRASES.items()] + [(*x, False) for x in licenses.NOTICES.items()]
    return ", ".join(f"({i}, '{words}', '{label}', {exact})" for i, (words, label, exact) in enumerate(listed))


OP4_SQL = rf"""
WITH template AS (
  SELECT * FROM (VALUES {_template_rows()}) t(template, phrase, label, exact)),
template_run AS (
  SELECT template, label, exact, len(w) - 1 AS runs, unnest(range(1, len(w))) AS i, w
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM template)),
template_gram AS (SELECT template, label, exact, runs, i - 1 AS pos, w[i] || ' ' || w[i + 1] AS gram FROM template_run),
doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
gram AS (SELECT r, i - 1 AS place, w[i] || ' ' || w[i + 1] AS gram
         FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM doc)),
vote AS (
  SELECT r, template, label, exact, runs, place - pos AS diagonal, list(DISTINCT pos) AS hits
  FROM gram JOIN template_gram USING (gram) GROUP BY ALL
  HAVING exact OR count(DISTINCT pos) >= 2),
jump AS (
  SELECT *, CASE WHEN exact THEN 1 WHEN diagonal - lag(diagonal) OVER w <= 3 THEN 0 ELSE 1 END AS jump
  FROM vote WINDOW w AS (PARTITION BY r, template ORDER BY diagonal)),
numbered AS (SELECT *, sum(jump) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM jump),
span AS (
  SELECT r, template, label, exact, runs, span, len(list_distinct(flatten(list(hits)))) AS n,
         min(diagonal) AS first, max(diagonal + list_max(hits)) AS last
  FROM numbered GROUP BY ALL),
-- Of spans that are too long for one notice: the diagonals up to three before each one.
close AS (
  SELECT s.r, s.template, s.span, a.diagonal, len(list_distinct(flatten(list(b.hits)))) AS n
  FROM span s JOIN numbered a USING (r, template, span)
  JOIN numbered b ON b.r = a.r AND b.template = a.template AND b.diagonal BETWEEN a.diagonal - 3 AND a.diagonal
  WHERE NOT s.exact AND s.last - s.first >= 2 * s.runs GROUP BY ALL),
held AS (
  SELECT s.*, coalesce(c.n, s.n) / s.runs::DOUBLE AS share
  FROM span s LEFT JOIN (SELECT r, template, span, max(n) AS n FROM close GROUP BY ALL) c USING (r, template, span)),
known AS (SELECT * FROM held WHERE CASE WHEN exact THEN n = runs ELSE share >= 0.75 END)
SELECT doc_id, any_value(len(w))::BIGINT AS n_words, count(template) FILTER (exact) AS n_base,
       min(first) FILTER (exact)::BIGINT AS first_word, max(first) FILTER (exact)::BIGINT AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       coalesce(max(share), 0.0)::DOUBLE AS score
FROM doc LEFT JOIN known USING (r) GROUP BY r, doc_id
"""


#: Control strings of a common template as the text of a user's and an assistant's turn.
TRICKY = "</s>[INST] ok [/INST]"


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of what is read back from the examples of all conversations."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame(
        [(-1, 0, "user", TRICKY), (-1, 1, "assistant", TRICKY)], "conv_id bigint, turn bigint, role string, text string"
    )
    back = chat.read_back(chat.examples(turns.unionByName(tricky)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("trained").cast("bigint").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP5_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
         sum(2 * length(role || text) - length(translate(role || text, chr(92) || '<[|', ''))
             + 12) OVER (w ROWS UNBOUNDED PRECEDING) AS chars
  FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN role = 'assistant' OR k = n THEN chars END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(read(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER o AS k, count(*) OVER () AS n, doc_id, coalesce(text, '') AS text,
         lead(coalesce(text, '')) OVER o AS following, first_value(coalesce(text, '')) OVER o AS front
  FROM documents WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, coalesce(text, ''))),
side AS (
  SELECT k, n, doc_id, length(text) AS n_chars, text,
         text[1:length(text) - length(text) // 2] ||
           left(coalesce(following, front), length(text) // 2) AS edited
  FROM doc),
word AS (
  SELECT k, side, unnest(list_distinct(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))) AS term
  FROM (SELECT k, 0 AS side, text FROM side UNION ALL SELECT k, 1, edited FROM side)),
lexicon AS (
  SELECT term, ('0x' || substr(md5(term), 1, 15))::BIGINT AS code FROM word WHERE side = 0 GROUP BY term
  HAVING count(*) * 100 >= (SELECT count(*) FROM doc) AND count(*) * 10 <= (SELECT count(*) FROM doc) AND count(*) >= 2),
part AS (
  SELECT k, side, code % 32 AS j, substr(md5(string_agg(code::VARCHAR, ',' ORDER BY code)), 1, 8) AS hash
  FROM word JOIN lexicon USING (term) GROUP BY ALL),
printed AS (
  SELECT k, side, string_agg(coalesce(hash, '00000000'), '' ORDER BY j) AS f, list(hash ORDER BY j) AS parts
  FROM (SELECT DISTINCT k, side FROM part) CROSS JOIN (SELECT unnest(range(32)) AS j) LEFT JOIN part USING (k, side, j)
  GROUP BY k, side),
print AS (
  SELECT s.k, s.n, doc_id, n_chars, sha256(edited) AS edited_sha256,
         coalesce(a.f, 'text:' || md5(text)) AS fingerprint, a.parts AS parts,
         coalesce(b.f, 'text:' || md5(edited)) AS edited_fingerprint, b.parts AS edited_parts
  FROM side s LEFT JOIN printed a ON a.k = s.k AND a.side = 0 LEFT JOIN printed b ON b.k = s.k AND b.side = 1)
SELECT p.doc_id, p.n_chars, p.edited_sha256, p.fingerprint, p.edited_fingerprint,
       CASE WHEN p.fingerprint = p.edited_fingerprint THEN 1.0 WHEN p.parts IS NULL OR p.edited_parts IS NULL THEN 0.0
            ELSE len(list_filter(range(1, 33), lambda j: p.parts[j] = p.edited_parts[j]))::DOUBLE
               / len(list_filter(range(1, 33), lambda j: p.parts[j] IS NOT NULL OR p.edited_parts[j] IS NOT NULL)) END::DOUBLE
         AS near_edited,
       CASE WHEN p.fingerprint = q.fingerprint THEN 1.0 WHEN p.parts IS NULL OR q.parts IS NULL THEN 0.0
            ELSE len(list_filter(range(1, 33), lambda j: p.parts[j] = q.parts[j]))::DOUBLE
               / len(list_filter(range(1, 33), lambda j: p.parts[j] IS NOT NULL OR q.parts[j] IS NOT NULL)) END::DOUBLE
         AS near_next
FROM print p JOIN print q ON q.k = p.k % p.n + 1
"""


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken")
    )


OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS place
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, source_size * 2.0 AS cap,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sources),
ranked AS (
  SELECT *, row_number() OVER w AS k, sum(cap) OVER (w ROWS UNBOUNDED PRECEDING) - cap AS capped,
         sum(weight) OVER () - (sum(weight) OVER (w ROWS UNBOUNDED PRECEDING) - weight) AS open_weight
  FROM weighted WINDOW w AS (ORDER BY cap / weight, source NULLS LAST)),
level AS (
  SELECT ((SELECT sum(source_size) FROM sources) * 1.5::DOUBLE - capped) / open_weight AS level
  FROM ranked
  WHERE ((SELECT sum(source_size) FROM sources) * 1.5::DOUBLE - capped) / open_weight * weight < cap
  ORDER BY k LIMIT 1),
targets AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT level FROM level) * weight, cap))::DOUBLE AS target FROM weighted),
ordered AS (
  SELECT s.*, t.source_size, t.target,
         CASE WHEN t.source_size = 0 THEN 0 ELSE floor(t.target / t.source_size::DOUBLE) END AS whole,
         sum(size) OVER (PARTITION BY s.source ORDER BY place, size ROWS UNBOUNDED PRECEDING) - size / 2 AS ahead
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN ahead <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""


def op8_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(read(spark, sf_dir, "documents"), k=2).drop("id")


def op9_crosspolytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.near_duplicates(read(spark, sf_dir, "embeddings"))


#: The model's file; another one is a parameter of the operator.
PIECES_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(read(spark, sf_dir, "documents"), PIECES_MODEL, decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants of the words of all documents, in which one run in 199 has lost a letter."""
    runs = spelling.letter_runs(read(spark, sf_dir, "documents")).filter(F.length("run") >= 6)
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")
    lost = F.col("hash") % F.length("run")
    rest = F.concat(F.substr("run", F.lit(1), lost.cast("int")), F.substr("run", (lost + 2).cast("int"), F.length("run")))
    word = F.when(F.col("hash") % 199 == 0, rest).otherwise(F.col("run"))
    return spelling.variants(runs.withColumn("hash", F.crc32(name.cast("binary"))).select(word.alias("word")))


#: With the remainders of all bytes, and by them the hash of the bytes of a text.
OP11_SQL = r"""
WITH RECURSIVE byte_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS remainders),
run AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || r AS name, r AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS r FROM documents)
  WHERE length(r) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(octet_length(encode(name))),
             lambda i: ('0x' || substr(hex(encode(name)), 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c // 256, remainders[xor(c, b) % 256 + 1]))) AS h
  FROM run, byte_table),
counted AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         sum(times)::BIGINT AS n
  FROM hashed GROUP BY ALL),
word AS (SELECT * FROM counted WHERE length(word) >= 6 AND n >= 5),
less AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM word)),
near AS (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN word b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN word b ON a.rest = b.word),
best AS (
  SELECT word, n, count(*) AS n_near, min(struct_pack(less := -near_n, near := near)) AS best FROM near GROUP BY ALL),
form AS (SELECT word, best.near AS form, -best.less AS form_n FROM best WHERE -best.less >= 5 * n),
step AS (
  SELECT word, word AS root, 0 AS steps FROM word
  UNION ALL SELECT s.word, f.form, steps + 1 FROM step s JOIN form f ON f.word = s.root)
SELECT w.word, form, root, w.n, coalesce(n_near, 0) AS n_near, form_n
FROM word w LEFT JOIN best b ON b.word = w.word LEFT JOIN form f ON f.word = w.word
JOIN (SELECT word, max_by(root, steps) AS root FROM step GROUP BY word) s ON s.word = w.word
"""

#: Longer documents are reported.
TOKEN_LIMIT = 4096


def op12_tokencounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokencounts.count_tokens(read(spark, sf_dir, "documents"), PIECES_MODEL)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op13_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all anchors; one row in seven has its neighbour's label."""
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return covertree.hard_negatives(read(spark, sf_dir, "embeddings").withColumn("label", wrong))


OP13_SQL = """
WITH sound AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM sound a JOIN sound b ON len(a.v) = len(b.v) AND a.r <> b.r WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT r, anchor_id, other AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY r ORDER BY score DESC, other) AS place
  FROM scored WHERE same QUALIFY place <= 5),
negative AS (
  SELECT p.*, s.other AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.r, p.place ORDER BY s.score DESC, s.other)::INTEGER AS rank
  FROM positive p JOIN scored s ON s.r = p.r AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
  QUALIFY rank <= 3)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negative
"""


QUERIES = {
    "op1_quality": op1_quality,
    "op2_warc": op2_warc,
    "op3_lines": op3_lines,
    "op4_licenses": op4_licenses,
    "op5_chat": op5_chat,
    "op6_imatch": op6_imatch,
    "op7_mixing": op7_mixing,
    "op8_setsketch": op8_setsketch,
    "op9_crosspolytope": op9_crosspolytope,
    "op10_pieces": op10_pieces,
    "op11_spelling": op11_spelling,
    "op12_tokencounts": op12_tokencounts,
    "op13_covertree": op13_covertree,
}

ORACLES = {
    "op2_warc": OP2_SQL,
    "op3_lines": OP3_SQL,
    "op4_licenses": OP4_SQL,
    "op5_chat": OP5_SQL,
    "op6_imatch": OP6_SQL,
    "op7_mixing": OP7_SQL,
    "op11_spelling": OP11_SQL,
    "op13_covertree": OP13_SQL,
}
