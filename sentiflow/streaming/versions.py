"""Scoring a stream with the newest of several model versions.

A model is added as a version beside the earlier ones and counts once it is complete. Each micro-batch
takes the version that counts when it begins, writes its rows and its line of the log into places named
after the batch, and skips what is there already: a batch that is run again after a failure neither
repeats rows nor counts twice, and a batch that was scored keeps the model it was scored by.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.models import score_or_reject
from ..sources.storage import names_in, remove

MARK = "_SUCCESS"
LOG = (
    "batch_id bigint, model_version string, requests bigint, rejected bigint, "
    "negative bigint, neutral bigint, positive bigint"
)


def add_model_version(model: PipelineModel, models_dir: str, spark: SparkSession, keep: int = 2) -> str:
    """Save ``model`` as the newest version and return the version's name.

    It is written under another name and renamed when all its parts are there. The last ``keep`` stay,
    for batches that have begun.
    """
    if keep < 1:
        raise ValueError("the new version stays at least")
    before = model_versions(spark, models_dir)
    number = max((int(name.split("-")[1]) for name in before), default=0) + 1
    name = f"version-{number:010}-{uuid.uuid4().hex[:8]}"
    model.write().save(f"{models_dir}/unfinished-{name}")
    path = spark._jvm.org.apache.hadoop.fs.Path
    unfinished = path(f"{models_dir}/unfinished-{name}")
    if not unfinished.getFileSystem(spark._jsc.hadoopConfiguration()).rename(unfinished, path(f"{models_dir}/{name}")):
        raise OSError(f"cannot place {name}")
    for old in before[: max(0, len(before) + 1 - keep)]:
        remove(spark, f"{models_dir}/{old}")
    return name


def model_versions(spark: SparkSession, models_dir: str) -> list[str]:
    """Names of the versions that are complete, the oldest first."""
    return [name for name in names_in(spark, models_dir) if name.startswith("version-")]


class _Batches:
    """Scores one micro-batch after the other. The model in use is loaded once per version."""

    def __init__(self, models_dir: str, out_dir: str, text: str):
        self.models_dir, self.out_dir, self.text = models_dir, out_dir, text
        self.version: str | None = None
        self.model: PipelineModel | None = None

    def __call__(self, requests: DataFrame, batch_id: int) -> None:
        spark = requests.sparkSession
        rows = f"{self.out_dir}/rows/batch_id={batch_id}"
        if MARK not in names_in(spark, rows):
            scored = score_or_reject(self._newest(spark), requests, self.text)
            scored.withColumn("model_version", F.lit(self.version)).write.mode("overwrite").parquet(rows)
        line = f"{self.out_dir}/log/batch_id={batch_id}"
        if MARK not in names_in(spark, line):
            # From the rows as written: the log tells of them whatever model there is by now.
            _counts(spark.read.parquet(rows)).write.mode("overwrite").parquet(line)

    def _newest(self, spark: SparkSession) -> PipelineModel:
        found = model_versions(spark, self.models_dir)
        if not found:
            raise ValueError(f"no model in {self.models_dir}")
        if found[-1] != self.version:
            self.model = PipelineModel.load(f"{self.models_dir}/{found[-1]}")
            self.version = found[-1]
        return self.model


def _counts(rows: DataFrame) -> DataFrame:
    classes = {n: F.count_if(F.col("label") == i) for i, n in enumerate(("negative", "neutral", "positive"))}
    return rows.agg(
        F.max("model_version").alias("model_version"),
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("status") == "rejected").alias("rejected"),
        *(count.alias(name) for name, count in classes.items()),
    )


def start_versioned_scoring(
    models_dir: str,
    requests: DataFrame,
    out_dir: str,
    checkpoint_dir: str,
    text: str = "text",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write every request with its score or reason (``score_or_reject``) and ``model_version``.

    ``out_dir`` belongs to ``checkpoint_dir``: batches are told apart by the numbers the checkpoint
    gives them. Read with ``read_scored`` and ``read_batch_log``.
    """
    return (
        requests.writeStream.foreachBatch(_Batches(models_dir, out_dir, text))
        .option("checkpointLocation", checkpoint_dir)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_scored(spark: SparkSession, out_dir: str) -> DataFrame:
    """The rows of all batches, with ``batch_id``."""
    return spark.read.parquet(f"{out_dir}/rows")


def read_batch_log(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row per batch: its model, its requests and rejects, and the predictions by class."""
    return spark.read.schema(LOG).parquet(f"{out_dir}/log")
