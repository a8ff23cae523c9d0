"""I-Match fingerprints with randomised lexicon subsets.

The lexicon holds the terms within a band of document frequency, counted over all documents: those in
at least one of ``rarest`` and at most one of ``commonest`` documents. As a document has a limited
number of distinct terms, the lexicon has at most ``rarest`` times their mean number, however many
documents there are. It is drawn into random subsets; a document's distinct terms in a subset, sorted
and hashed, are one part of its fingerprint.

Texts are shuffled once, to ranges of their order, so that a document's neighbour is in its task; the
lexicon is broadcast after its bound, and everything else stays within these tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookup import BROADCAST_BYTES, table_bytes
from ..sources.storage import stage
from .common import NOT_WORD, ascii_lower, text_or_empty

RAREST = 100
COMMONEST = 10
SUBSETS = 32
#: Hex digits of each subset's hash; so many zeros for a subset without terms.
DIGITS = 8
ROWS_PER_RANGE = 5_000
MAX_RANGES = 16_384


def terms(text: Column) -> Column:
    """Distinct words of a text, and the empty one, which every text has."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(ascii_lower(text), NOT_WORD)))


def lexicon(docs: DataFrame, rarest: int = RAREST, commonest: int = COMMONEST) -> DataFrame:
    """``term``, ``code`` (60 bits of its hash) of terms in the band; and the empty term, without code.

    A term is in two documents at least. Without documents only the empty term is there.
    """
    n = docs.count()
    counted = docs.select(F.explode(terms(text_or_empty())).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    in_band = (F.col("df") * rarest >= n) & (F.col("df") * commonest <= n) & (F.col("df") >= 2)
    code = F.conv(F.substring(F.md5("term"), 1, 15), 16, 10).cast("bigint")
    band = counted.filter(in_band & (F.col("term") != "")).select("term", code.alias("code"))
    every = docs.sparkSession.createDataFrame([("", None)], "term string, code bigint")
    return stage(band, "imatch-lexicon").unionByName(every)


def fingerprint(codes: Column, plain: Column, subsets: int = SUBSETS) -> Column:
    """Hashes of a document's sorted distinct codes in each subset; of its text if it has none."""
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(subsets - 1)),
        lambda j: F.array_join(F.filter(codes, lambda c: c % subsets == j).cast("array<string>"), ","),
    )
    hashed = F.transform(
        parts, lambda part: F.when(part == "", "0" * DIGITS).otherwise(F.substring(F.md5(part), 1, DIGITS))
    )
    return F.when(F.size(codes) == 0, F.concat(F.lit("text:"), plain)).otherwise(F.array_join(hashed, ""))


def likeness(one: Column, other: Column, subsets: int = SUBSETS) -> Column:
    """Share of equal parts among those where either fingerprint has terms. 1 for equal fingerprints;
    0 if one is of a text without terms in the lexicon and the other differs."""
    none = F.lit("0" * DIGITS)
    places = F.sequence(F.lit(0), F.lit(subsets - 1))
    at = lambda f, j: f.substr(j * DIGITS + 1, F.lit(DIGITS))
    used = F.size(F.filter(places, lambda j: (at(one, j) != none) | (at(other, j) != none)))
    same = F.size(F.filter(places, lambda j: (at(one, j) == at(other, j)) & (at(one, j) != none)))
    by_text = one.startswith("text:") | other.startswith("text:")
    return F.when(one == other, 1.0).when(by_text, 0.0).otherwise(same / used)


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are below ``value``, by binary search."""
    listed = F.array(*(F.lit(b).cast("bigint") for b in bounds))
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def step(found: Column, width: Column) -> Column:
        reached = found + width
        return F.when((reached <= len(bounds)) & (F.get(listed, reached - 1) < value), reached).otherwise(found)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def in_order(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``range``, ``place``, ``guest``, ``doc_id``, ``text`` and ``next_text``: rows by descending
    ``doc_id`` (null last, equal ones by text), each with the text that follows; the first follows the
    last.

    The order is cut into ranges at ids of the data. The first row of each range is also in the range
    before as its ``guest``, after the last row, so that no row's neighbour is elsewhere.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    n, least = rows.agg(F.count(F.lit(1)), F.min("doc_id")).first()
    at = F.coalesce(F.col("doc_id"), F.lit((least or 0) - 1))
    ranges = max(1, min(MAX_RANGES, -(-n // rows_per_range)))
    shares = [(i + 1) / ranges for i in range(ranges - 1)]
    cuts, most = rows.select(at.alias("at")).agg(
        F.percentile_approx("at", shares or [0.5], max(10_000, 4 * ranges)), F.max("at")
    ).first()
    bounds = sorted({*(cuts if shares and cuts else []), most if most is not None else 0})
    own = _range_of(F.col("at"), bounds)
    placed = rows.select("doc_id", "text", at.alias("at")).withColumn("own", own)
    is_first = F.col("at") == F.get(F.array(*(F.lit(b).cast("bigint") for b in bounds)), F.col("own"))
    homes = F.when(is_first, F.array(F.col("own"), (F.col("own") + 1) % len(bounds))).otherwise(F.array("own"))
    there = placed.select("doc_id", "text", "at", F.posexplode(homes).alias("guest", "range"))
    order = Window.partitionBy("range").orderBy("guest", F.col("at").desc(), "text")
    return there.select(
        "range",
        F.row_number().over(order).alias("place"),
        "guest",
        F.lag("guest").over(order).alias("guest_before"),
        "doc_id",
        "text",
        F.lead("text").over(order).alias("next_text"),
    ).filter("guest = 0 or guest_before = 0").drop("guest_before")


def fingerprints(
    docs: DataFrame, rarest: int = RAREST, commonest: int = COMMONEST, subsets: int = SUBSETS, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """For each row of ``docs`` (``doc_id``, ``text``): ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``.

    The edited text is the first half of the text followed by as much of the beginning of the next
    document's (all of it, if it is shorter). Null texts are empty. Other columns are ignored. Ids are
    taken to be near unique: rows with one id are in one range.
    """
    words = lexicon(docs, rarest, commonest)
    if table_bytes(words) <= BROADCAST_BYTES:
        words = F.broadcast(words)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.col("text").substr(F.lit(1), (F.col("n_chars") - half).cast("int")),
        F.coalesce(F.col("next_text").substr(F.lit(1), half), F.lit("")),
    )
    ordered = in_order(docs, rows_per_range).withColumn("n_chars", F.length("text").cast("bigint"))
    sides = ordered.select(
        "range", "place", "guest", "doc_id", "n_chars", F.posexplode(F.array("text", edited)).alias("side", "text")
    )
    # Digests are made before terms are exploded, once per text.
    digested = sides.select(
        *("range", "place", "guest", "side", "doc_id", "n_chars", "text"),
        F.when(F.col("side") == 0, F.md5("text")).otherwise(F.sha2("text", 256)).alias("digest"),
        F.when(F.col("side") == 1, F.md5("text")).alias("edited_plain"),
    )
    said = digested.withColumn("term", F.explode(terms(F.col("text")))).drop("text")
    once = F.col("term") == ""  # values of the document are taken from its row for the empty term
    value = lambda name, side=0: F.max(F.when(once & (F.col("side") == side), F.col(name)))
    codes = lambda side: F.collect_set(F.when(F.col("side") == side, F.col("code")))
    gathered = said.join(words, "term").groupBy("range", "place").agg(
        value("guest").alias("guest"),
        value("doc_id").alias("doc_id"),
        value("n_chars").alias("n_chars"),
        value("digest").alias("plain"),
        value("digest", 1).alias("edited_sha256"),
        value("edited_plain", 1).alias("edited_plain"),
        codes(0).alias("codes"),
        codes(1).alias("edited_codes"),
    )
    gathered = gathered.withColumns({c: F.array_sort(c) for c in ("codes", "edited_codes")})
    made = gathered.select(
        *("range", "place", "guest", "doc_id", "n_chars", "edited_sha256"),
        fingerprint(F.col("codes"), F.col("plain"), subsets).alias("fingerprint"),
        fingerprint(F.col("edited_codes"), F.col("edited_plain"), subsets).alias("edited_fingerprint"),
    )
    following = F.lead("fingerprint").over(Window.partitionBy("range").orderBy("place"))
    return made.withColumn("next", following).filter("guest = 0").select(
        *("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), subsets).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next"), subsets).alias("near_next"),
    )
