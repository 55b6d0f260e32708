"""Comparison of candidates with a baseline, and promotion of the winner."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from wattline.errors import TrainingError
from wattline.operators.evaluate import DEFAULT_METRICS, metric_violations
from wattline.operators.models import ModelDefinition
from wattline.operators.search import Trial, search
from wattline.operators.select import champion_vs_baseline
from wattline.plans.runlog import now
from wattline.sources.tables import COMPARISON_SCHEMA, append_rows, register


@dataclass(frozen=True)
class Candidate:
    model_id: str
    metrics: dict[str, float]
    artifact_path: str
    hyperparameters: dict[str, str] = field(default_factory=dict)


def candidate(trial: Trial) -> Candidate:
    params = {k: str(v) for k, v in trial.definition.params.items()}
    return Candidate(trial.definition.name, trial.metrics, trial.model_path, params)


def candidate_table(spark: SparkSession, baseline: Candidate, candidates: Sequence[Candidate], metric: str) -> DataFrame:
    rows = [
        (i, c.model_id, c.metrics.get(metric), c.artifact_path, c.metrics, c.hyperparameters, i == 0)
        for i, c in enumerate([baseline, *candidates])
    ]
    return spark.createDataFrame(
        rows,
        "ordinal bigint, model_id string, score double, artifact_path string, metrics map<string,double>, "
        "hyperparameters map<string,string>, is_baseline boolean",
    )


def promote_from_results(
    spark: SparkSession,
    baseline: Candidate,
    candidates: Sequence[Candidate],
    metric: str = "rmse",
    reports: str | None = None,
    registry: str | None = None,
) -> Candidate:
    """Pick the winner from given metrics; write the report and register the winner where paths are given."""
    entries = candidate_table(spark, baseline, candidates, metric)
    unsound = metric_violations(entries, [metric], "model_id").collect()
    if unsound:
        raise TrainingError(f"unsound metrics: {[tuple(r) for r in unsound]}")
    best = champion_vs_baseline(entries, "score").first()
    winner = [baseline, *candidates][best["ordinal"]]
    if reports:
        run_id, stamp = uuid.uuid4().hex, now().isoformat()
        rows = [
            (
                run_id, stamp, c.model_id, "baseline" if i == 0 else "candidate", c.metrics, c.hyperparameters,
                c.artifact_path, i == best["ordinal"], metric,
            )
            for i, c in enumerate([baseline, *candidates])
        ]
        append_rows(spark, reports, rows, COMPARISON_SCHEMA)
    if registry:
        register(spark, registry, winner.model_id, winner.artifact_path, winner.metrics, now().isoformat())
    return winner


def compare_models(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    baseline: ModelDefinition,
    candidates: Sequence[ModelDefinition],
    target: str = "total_load",
    metric: str = "rmse",
    models_path: str | None = None,
    reports: str | None = None,
    registry: str | None = None,
) -> tuple[Candidate, list[Trial]]:
    """Fit baseline and candidates on the same slice, judge them together, promote the winner."""
    trials = search(
        train, test, features, target, [baseline, *candidates], DEFAULT_METRICS, models_path, fail_fast=True
    )
    made = [candidate(t) for t in trials]
    return promote_from_results(train.sparkSession, made[0], made[1:], metric, reports, registry), trials
