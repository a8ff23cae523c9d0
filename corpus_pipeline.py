"""From a raw corpus to training sequences: five stages, each over all that the one before has kept.

``STAGES`` lists them in order. Each takes the session, the documents and the folder of the other
tables; what it returns is written as Parquet and read again for the next one. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentiflow.llm import lines, mixing, pieces, quality, setsketch
from sentiflow.llm.common import read
from sentiflow.llm.queries import PIECES_MODEL
from sentiflow.sources.storage import stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the quality classifier rejects. It learns from the labels of the
    documents given, as far as they are not held out."""
    return quality.good_documents(docs, read(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without all but the first occurrence of lines that spread over many sources."""
    return lines.deduplicated(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: shingles of five words, similarity 0.8."""
    return setsketch.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with an end id, and a digest of the text they decode to:
    ``doc_id``, ``n_tokens``, ``ids``, ``decoded_sha256``."""
    encoded = pieces.encode(docs, PIECES_MODEL, decoded=True)
    digest = F.sha2("decoded", 256).alias("decoded_sha256")
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", digest)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_documents),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: Models, sketches and token merges have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
