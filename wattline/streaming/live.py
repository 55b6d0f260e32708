"""Scoring and live metrics on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattline.functions.calendar import from_wall_micros, wall_micros
from wattline.functions.names import matching
from wattline.operators.clean import KW_TO_KWH, coerce_numeric
from wattline.operators.drift import DRIFT_THRESHOLD, drift_flag
from wattline.operators.features import engineer_wide
from wattline.operators.models import predict


def score_stream(stream: DataFrame, model: PipelineModel, factor: float | None = KW_TO_KWH, target: str = "total_load") -> DataFrame:
    """Rows of wide readings with their prediction. Stateless, so it runs as a plain projection per batch."""
    numbers = coerce_numeric(stream, matching(stream), factor)
    return predict(model, engineer_wide(numbers, target=target).drop(target), ["timestamp"])


def live_metrics(
    predictions: DataFrame,
    baseline_rmse: float,
    ts: str = "ts",
    width: str = "1 day",
    lateness: str = "1 hour",
    threshold: float = DRIFT_THRESHOLD,
    by: Sequence[str] = (),
) -> DataFrame:
    """RMSE, MSE and drift flag per closed time window; rows later than ``lateness`` are dropped.

    State is one row per open window. Works on a stream in append mode and on a batch. Windows
    follow the wall clock of ``ts`` in every session time zone.
    """
    # Watermarks need a zoned timestamp: the instant that UTC shows as the wall clock time.
    timed = predictions.withColumn("_at", F.timestamp_micros(wall_micros(F.col(ts))))
    if predictions.isStreaming:
        timed = timed.withWatermark("_at", lateness)
    squared = F.avg(F.pow(F.col("label") - F.col("prediction"), 2))
    windows = timed.groupBy(F.window("_at", width), *by).agg(F.count(F.lit(1)).alias("n_rows"), squared.alias("mse"))
    rmse = F.sqrt("mse")
    return windows.select(
        from_wall_micros(F.unix_micros("window.start")).alias("window_start"),
        *by,
        "n_rows",
        rmse.alias("rmse"),
        "mse",
        drift_flag(F.lit(float(baseline_rmse)), rmse, threshold).alias("drift_detected"),
    )


def run_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all that is available to Parquet, exactly once, and stop."""
    query = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
