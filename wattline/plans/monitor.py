"""Monitoring job: champion against live data, drift flag, report."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.errors import RegistryError
from wattline.operators.drift import DRIFT_THRESHOLD, PRIMARY_METRIC, detect_drift, latest_report, retrain_decision
from wattline.operators.evaluate import evaluate_one
from wattline.operators.models import load_model
from wattline.operators.split import VAL_END, day_bound
from wattline.plans.prepare import PrepareOptions, gated
from wattline.plans.runlog import RunLog, now
from wattline.sources.tables import REPORT_SCHEMA, append_rows, load_champion, read_table


@dataclass(frozen=True)
class MonitorOptions:
    registry: str
    reports: str
    run_log: str | None = None
    prepare: PrepareOptions = field(default_factory=PrepareOptions)
    live_after: str = VAL_END
    primary_metric: str = PRIMARY_METRIC
    drift_threshold: float = DRIFT_THRESHOLD


def live_slice(engineered: DataFrame, live_after: str = VAL_END, test_end: str | None = None) -> DataFrame:
    """The rows behind the validation bound, as a plain range that reaches a Parquet scan."""
    at = F.col("timestamp")
    live = engineered.where(at > day_bound(live_after))
    return live if test_end is None else live.where(at <= day_bound(test_end))


def is_drift(spark: SparkSession, baseline: float, live: float, threshold: float = DRIFT_THRESHOLD) -> bool:
    pair = spark.createDataFrame([(float(baseline), float(live))], "baseline double, live double")
    return bool(detect_drift(pair, threshold).first()["drift_detected"])


def monitor_job(raw: DataFrame, options: MonitorOptions) -> bool:
    """True when the primary metric drifted. The report is appended either way."""
    spark = raw.sparkSession
    target = options.prepare.target
    with RunLog(spark, options.run_log, "monitor", {"metric": options.primary_metric}) as log:
        with log.phase("champion"):
            record = load_champion(spark, options.registry)
            model = load_model(record["model_path"])
        with log.phase("evaluate"):
            live = live_slice(gated(raw, options.prepare), options.live_after)
            scored = model.transform(live.withColumn("label", F.col(target).cast("double")))
            metrics = evaluate_one(scored.select("label", "prediction"))
        with log.phase("drift"):
            metric = options.primary_metric
            drift = is_drift(spark, record["metrics"][metric], metrics[metric], options.drift_threshold)
        with log.phase("report"):
            row = (log.run_id, now().isoformat(), record["version"], drift, dict(record["metrics"]), metrics)
            append_rows(spark, options.reports, [row], REPORT_SCHEMA)
    return drift


def decide_retrain(spark: SparkSession, reports: str) -> DataFrame:
    """The newest report with its alert and retrain decision; an error when there is no report."""
    newest = latest_report(read_table(spark, reports, REPORT_SCHEMA))
    if newest.isEmpty():
        raise RegistryError(f"no monitoring report at {reports!r}")
    return retrain_decision(newest)
