"""Collections of documents that are replaced as a whole.

``overwrite`` deletes a collection before it writes the new one, so a job that fails in between leaves
none. Here every replacement is a version of its own beside the one before. A version counts from the
moment all its tasks have committed, when the writer leaves its mark of success; until then, and if
that moment never comes, readers see the version before.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.storage import names_in, remove

MARK = "_SUCCESS"


def versions(spark: SparkSession, path: str) -> list[str]:
    """Paths of the versions that count, the oldest first."""
    return [f"{path}/{name}" for name in _all(spark, path) if MARK in names_in(spark, f"{path}/{name}")]


def _all(spark: SparkSession, path: str) -> list[str]:
    return [name for name in names_in(spark, path) if name.startswith("version-")]


def replace_collection(df: DataFrame, path: str, fmt: str = "json", keep: int = 2) -> str:
    """Replace the collection at ``path`` with the rows of ``df``, written in parallel.

    The last ``keep`` versions stay, for readers that have begun with an older one; others that
    counted are removed after the new one counts. What a failed job has left behind is removed by the
    next replacement that is a version later. ``df`` may read the collection it replaces. Returns the
    path of the new version.
    """
    if keep < 1:
        raise ValueError("the new version stays at least")
    spark = df.sparkSession
    before = _all(spark, path)
    number = max((int(name.split("-")[1]) for name in before), default=0) + 1
    # Two writers at once have versions of their own; the later name counts.
    new = f"version-{number:010}-{uuid.uuid4().hex[:8]}"
    options = {"ignoreNullFields": "false"} if fmt == "json" else {}
    df.write.format(fmt).options(**options).mode("errorifexists").save(f"{path}/{new}")
    counting = [p.rsplit("/", 1)[1] for p in versions(spark, path)]
    stay = {*counting[-keep:], new}
    for name in before:
        if name not in stay:
            remove(spark, f"{path}/{name}")
    return f"{path}/{new}"


def read_collection(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json") -> DataFrame:
    """The rows of the version that counts now. A collection that was never written has none."""
    found = versions(spark, path)
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).load(found[-1])
