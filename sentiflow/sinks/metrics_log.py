"""A log of metrics, one row per run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "run_id string, run_ts timestamp, Accuracy double, F1 double, Precision double, Recall double"
)


def write_metrics(metrics: DataFrame, path: str, run_id: str, run_ts: datetime | None = None) -> None:
    """Append one run's metrics (``weighted_metrics``)."""
    at = F.current_timestamp() if run_ts is None else F.lit(run_ts)
    row = metrics.select(
        F.lit(run_id).alias("run_id"), at.alias("run_ts"), "Accuracy", "F1", "Precision", "Recall"
    )
    row.coalesce(1).write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def latest_metrics(log: DataFrame) -> DataFrame:
    """The row of the last run; no row when the log is empty."""
    row = F.struct(*log.columns)
    last = log.agg(F.max_by(row, F.struct("run_ts", "run_id")).alias("row"))
    return last.filter(F.col("row").isNotNull()).select("row.*")
