"""Result tables as CSV, published together.

A run's tables are written into a folder of their own first. Then one small file, the manifest, appears
under its final name: that is the moment from which ``read_published`` gives the new set. A run that
fails before leaves the former set as it was, and no reader gets tables of two runs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.storage import names_in, remove

LATEST = "latest"
SETS = "sets"
MANIFESTS = "manifests"


def publish(
    results: Mapping[str, DataFrame],
    out_dir: str,
    run_id: str,
    latest: bool = False,
    order: Mapping[str, Sequence[Column | str]] | None = None,
    keep: int = 2,
) -> dict[str, str]:
    """Write each table as one CSV file with a header and publish all of them at once.

    ``order`` gives the row order of a file. Tables are reports of a few rows. They are brought
    together by a shuffle and not by narrowing the last stage, so what computes them stays parallel.

    For readers of plain paths the files are copied to ``<out>/<name>/run_id=<run_id>`` and, with
    ``latest=True``, the whole set to ``<out>/latest``; this happens when all tables are there, and
    each folder is put in place by a rename. ``latest`` holds one set, without tables that only an
    earlier run had. The last ``keep`` sets stay for readers that have begun. Returns the run's path of
    every table.
    """
    if keep < 1:
        raise ValueError("the new set stays at least")
    if not results:
        raise ValueError("no tables to publish")
    taken = {SETS, MANIFESTS, LATEST} & set(results)
    if taken:
        raise ValueError(f"names in use: {sorted(taken)}")
    spark = next(iter(results.values())).sparkSession
    number = max((int(n.split("-")[0]) for n in names_in(spark, f"{out_dir}/{MANIFESTS}")), default=0) + 1
    # Two writers at once have sets of their own; the later name counts.
    name_of_set = f"{number:010}-{uuid.uuid4().hex[:8]}"
    folder = f"{out_dir}/{SETS}/{name_of_set}"
    for name, table in results.items():
        _write_csv(table, f"{folder}/{name}", (order or {}).get(name, ()))
    manifest = {
        "run_id": run_id,
        "set": name_of_set,
        "tables": {name: table.schema.jsonValue() for name, table in results.items()},
    }
    _put(spark, f"{out_dir}/{MANIFESTS}/{name_of_set}", json.dumps(manifest))
    paths = {name: f"{out_dir}/{name}/run_id={run_id}" for name in results}
    for name, path in paths.items():
        _copy(spark, f"{folder}/{name}", path)
    if latest:
        _copy(spark, folder, f"{out_dir}/{LATEST}")
    # A set without a manifest is left by a run that failed, or belongs to one that is still at work:
    # those after this one are not touched.
    stay = set(names_in(spark, f"{out_dir}/{MANIFESTS}")[-keep:]) | {name_of_set}
    for old in names_in(spark, f"{out_dir}/{SETS}"):
        if old not in stay and int(old.split("-")[0]) < number:
            remove(spark, f"{out_dir}/{MANIFESTS}/{old}")
            remove(spark, f"{out_dir}/{SETS}/{old}")
    return paths


def published_run(spark: SparkSession, out_dir: str) -> str | None:
    """The run whose tables count now."""
    manifest = _manifest(spark, out_dir)
    return manifest["run_id"] if manifest else None


def read_published(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The tables of the set that counts now, all of one run; none if nothing was published."""
    manifest = _manifest(spark, out_dir)
    if not manifest:
        return {}
    folder = f"{out_dir}/{SETS}/{manifest['set']}"
    return {
        name: spark.read.schema(T.StructType.fromJson(schema)).csv(f"{folder}/{name}", header=True)
        for name, schema in manifest["tables"].items()
    }


def _manifest(spark: SparkSession, out_dir: str) -> dict | None:
    names = names_in(spark, f"{out_dir}/{MANIFESTS}")
    if not names:
        return None
    return json.loads(spark.read.text(f"{out_dir}/{MANIFESTS}/{names[-1]}", wholetext=True).first().value)


def _write_csv(table: DataFrame, path: str, order: Sequence[Column | str]) -> None:
    single = table.repartition(1)
    if order:
        single = single.sortWithinPartitions(*order)
    single.write.mode("errorifexists").option("header", True).csv(path)


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A file that is there as a whole or not at all: written under a hidden name, then renamed."""
    target, system = _path(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(target.getParent().getParent(), f".{target.getName()}")
    system.mkdirs(target.getParent())
    out = system.create(hidden, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not system.rename(hidden, target):
        raise OSError(f"cannot place {path}")


def _copy(spark: SparkSession, source: str, target: str) -> None:
    """Put a copy of a folder of small files in place of what is at ``target``."""
    origin, system = _path(spark, source)
    place, _ = _path(spark, target)
    beside = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}-{uuid.uuid4().hex[:8]}")
    system.mkdirs(place.getParent())
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(system, origin, system, beside, False, spark._jsc.hadoopConfiguration())
    system.delete(place, True)
    if not system.rename(beside, place):
        raise OSError(f"cannot place {target}")


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())
