"""Drift of live metrics against the champion's metrics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.operators.evaluate import lookup

# Watched metric, allowed relative rise, and ratios per metric.
PRIMARY_METRIC = "rmse"
DRIFT_THRESHOLD = 0.10
DRIFT_RATIOS = {"rmse": 1.10, "mse": 1.10}


def drift_flag(baseline: Column, live: Column, threshold: float = DRIFT_THRESHOLD) -> Column:
    """True when the metric rose by more than the share; a baseline of zero never drifts."""
    return F.when(baseline == 0, F.lit(False)).otherwise((live - baseline) / baseline > F.lit(threshold))


def relative_change(baseline: Column, live: Column) -> Column:
    return F.when(baseline != 0, (live - baseline) / baseline)


def detect_drift(pairs: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Adds ``relative_change`` and ``drift_detected`` to rows that carry ``baseline`` and ``live``."""
    base, live = F.col("baseline"), F.col("live")
    return pairs.withColumns(
        {"relative_change": relative_change(base, live), "drift_detected": drift_flag(base, live, threshold)}
    )


def drift_ratios(pairs: DataFrame, ratios: Mapping[str, float] = DRIFT_RATIOS) -> DataFrame:
    """Per metric: is live above baseline times its ratio? Metrics without a ratio give no row."""
    return (
        pairs.withColumn("ratio", lookup(F.col("metric"), ratios))
        .where(F.col("ratio").isNotNull())
        .withColumn("exceeded", F.col("live") > F.col("baseline") * F.col("ratio"))
    )


def latest_report(reports: DataFrame, by: str | None = None) -> DataFrame:
    """The newest report by its time, the run id deciding ties."""
    keys = [by] if by else []
    columns = [c for c in reports.columns if c not in keys]
    newest = F.max_by(F.struct(*columns), F.struct("timestamp", "run_id"))
    return reports.groupBy(*keys).agg(newest.alias("_last")).where("_last is not null").select(*keys, "_last.*")


def retrain_decision(report: DataFrame) -> DataFrame:
    """The newest report's alert and retrain decision."""
    drifted = F.coalesce(F.col("drift_detected"), F.lit(False))
    return report.withColumns({"alert": drifted, "retrain_required": drifted})
