"""Training job: data, search, registration, with a phase log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from wattline.operators.models import DEFAULT_MODELS, ModelDefinition
from wattline.operators.search import Halving, Trial, best_trial, search
from wattline.operators.split import TRAIN_END, VAL_END, feature_columns, split_frames
from wattline.plans.prepare import PrepareOptions, gated
from wattline.plans.runlog import RunLog, now
from wattline.sources.tables import TRIAL_METRICS_SCHEMA, append_rows, publish, register


@dataclass(frozen=True)
class TrainOptions:
    base: str
    prepare: PrepareOptions = field(default_factory=PrepareOptions)
    train_end: str = TRAIN_END
    val_end: str = VAL_END
    definitions: Sequence[ModelDefinition] = DEFAULT_MODELS
    features: Sequence[str] | None = None
    scoring: str = "rmse"
    parallelism: int = 4
    strategy: str = "grid"
    max_trials: int | None = None
    halving: Halving | None = None
    training_params: dict[str, str] = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.base.rstrip('/')}/{table}"


@dataclass
class TrainResult:
    run_id: str
    trials: list[Trial]
    best: Trial
    version: str
    engineered: str


def log_trials(spark: SparkSession, path: str, trials: Sequence[Trial], training_params: dict[str, str]) -> None:
    stamp = now().isoformat()
    rows = [
        (
            t.run_id, t.definition.name, t.model_path, t.metrics,
            {k: str(v) for k, v in t.definition.params.items()}, training_params, stamp,
        )
        for t in trials
        if t.status == "success"
    ]
    if rows:
        append_rows(spark, path, rows, TRIAL_METRICS_SCHEMA)


def train_job(raw: DataFrame, options: TrainOptions) -> TrainResult:
    """Engineer once into Parquet, fit every definition on the train slice, register the best.

    The engineered table is the only large result and is written once; the fits scan it.
    """
    spark = raw.sparkSession
    target = options.prepare.target
    with RunLog(spark, options.path("run_phases"), "train", {"scoring": options.scoring}) as log:
        with log.phase("data"):
            path = publish(gated(raw, options.prepare), options.path("engineered"))
            engineered = spark.read.parquet(path)
        with log.phase("model_search"):
            train, validation, _ = split_frames(engineered, options.train_end, options.val_end)
            features = options.features or feature_columns(engineered, target)
            trials = search(
                train, validation, features, target, options.definitions,
                models_path=options.path("models"), parallelism=options.parallelism,
                strategy=options.strategy, max_trials=options.max_trials, halving=options.halving,
                trials_path=options.path("halving_rungs") if options.strategy == "halving" else None,
            )
            log_trials(spark, options.path("trial_metrics"), trials, options.training_params)
            best = best_trial(trials, options.scoring)
        with log.phase("registry"):
            version = register(
                spark, options.path("registry"), best.definition.name, best.model_path, best.metrics, now().isoformat()
            )
    return TrainResult(log.run_id, trials, best, version, path)
