"""Scoring a stream of requests."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.models import score_or_reject


def start_scoring(
    model: PipelineModel,
    requests: DataFrame,
    out_dir: str,
    checkpoint_dir: str,
    text: str = "text",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write every request as parquet, under ``status=scored`` or ``status=rejected`` of ``out_dir``.

    Stateless, one row out per request: the source is read and cleaned once, requests without words
    are told apart by ``error`` and none can fail the query. One checkpoint, so restarts neither lose
    nor repeat rows. The default trigger processes what is there and stops.
    """
    return (
        score_or_reject(model, requests, text)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("status")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
