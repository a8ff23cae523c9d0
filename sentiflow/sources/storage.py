"""Shared storage for intermediate tables.

A staged table cuts lineage, lets later passes read only the columns they need, and is still there
when executors are lost. It lives in the folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sentiflow-"))
        return context.getCheckpointDir().rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/sentiflow/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), under: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet to shared storage and read it back.

    Filters on ``partition_by`` columns later skip whole files. ``under`` is a ``scratch_path`` whose
    tables are removed together.
    """
    path = f"{under}/{name}" if under else scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none where there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in system.listStatus(folder)) if system.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete what was staged under a ``scratch_path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
