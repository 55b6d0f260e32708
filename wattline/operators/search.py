"""Fitting several model definitions and keeping the score of each."""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import random
import threading
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.errors import OptionError, TrainingError
from wattline.operators.evaluate import DEFAULT_METRICS, evaluate
from wattline.operators.linear import gram
from wattline.operators.models import DEFAULT_MODELS, Model, ModelDefinition, fit, load_model, save_model
from wattline.sources.tables import append_rows, read_table

TRIAL_SCHEMA = T.StructType(
    [
        T.StructField("ordinal", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("model_kind", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("status", T.StringType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)


@dataclass
class Trial:
    ordinal: int
    run_id: str
    definition: ModelDefinition
    metrics: dict[str, float]
    status: str
    model_path: str
    error_message: str | None = None
    model: Model | None = None

    def row(self):
        params = {k: str(v) for k, v in self.definition.params.items()}
        return (
            self.ordinal, self.run_id, self.definition.name, self.definition.kind,
            params, self.metrics, self.status, self.model_path, self.error_message,
        )


def grid(
    name: str, kind: str, options: Mapping[str, Sequence[Any]], fixed: Mapping[str, Any] | None = None,
    max_trials: int | None = None,
) -> list[ModelDefinition]:
    """One definition per combination of options, the last option varying fastest."""
    combinations = itertools.product(*options.values())
    made = [
        ModelDefinition(f"{name}_{i}", kind, {**(fixed or {}), **dict(zip(options, values))})
        for i, values in enumerate(combinations)
    ]
    return made if max_trials is None else made[:max_trials]


STRATEGIES = ("grid", "random", "halving")


def choose(definitions: Sequence[ModelDefinition], strategy: str = "grid", max_trials: int | None = None, seed: int = 42) -> list[ModelDefinition]:
    """The definitions to try, at most ``max_trials``: the first ones, or with "random" others drawn by the seed, in their order."""
    if strategy not in STRATEGIES:
        raise OptionError(f"unknown strategy {strategy!r}; known: {list(STRATEGIES)}")
    if max_trials is not None and max_trials < 1:
        raise OptionError(f"max_trials must be positive, not {max_trials}")
    if max_trials is None or max_trials >= len(definitions):
        return list(definitions)
    if strategy == "random":
        return [definitions[k] for k in sorted(random.Random(seed).sample(range(len(definitions)), max_trials))]
    return list(definitions[:max_trials])


def _score(held: DataFrame, trials: Sequence[Trial], metrics: Sequence[str], fail_fast: bool) -> None:
    """Fill in the metrics of fitted trials, all judged in one grouped pass. Models that are expressions share one scan of ``held``."""
    parts = []
    plain = [t for t in trials if hasattr(t.model, "column")]
    if plain:
        guesses = F.array(*[F.struct(F.lit(t.ordinal).alias("ordinal"), t.model.column().alias("prediction")) for t in plain])
        parts.append(held.select("label", F.explode(guesses).alias("p")).select("p.ordinal", "label", "p.prediction"))
    for t in trials:
        if not hasattr(t.model, "column"):
            parts.append(t.model.transform(held).select(F.lit(t.ordinal).alias("ordinal"), "label", F.col("prediction").cast("double").alias("prediction")))
    if not parts:
        return
    scored = evaluate(reduce(DataFrame.unionAll, parts), ["ordinal"], metrics)
    # one row per definition
    by_ordinal = {r["ordinal"]: r for r in scored.collect()}
    for trial in trials:
        row = by_ordinal.get(trial.ordinal)
        if row is None or row["n_broken"]:
            if fail_fast:
                raise TrainingError(f"model {trial.definition.name!r} cannot be evaluated")
            trial.status, trial.model_path, trial.error_message = "failed", "N/A", "no usable predictions"
        else:
            trial.metrics = {m: float(row[m]) for m in metrics}


def _attempts(
    slice_: DataFrame, held: DataFrame, features: Sequence[str], target: str, items: Sequence[tuple[int, ModelDefinition]], metrics: Sequence[str],
    models_path: str | None, parallelism: int, fail_fast: bool,
) -> list[Trial]:
    """Fit and judge definitions with their ordinals. Elastic nets share one Gram matrix."""
    lock, known = threading.Lock(), {}

    def sums():
        with lock:
            if "sums" not in known:
                known["sums"] = gram(slice_, features, target)
            return known["sums"]

    def attempt(item: tuple[int, ModelDefinition]) -> Trial:
        ordinal, definition = item
        run_id = uuid.uuid4().hex
        try:
            model = fit(definition, slice_, features, target, sums() if definition.kind == "elastic_net" else None)
            path = save_model(model, models_path, definition.name, run_id) if models_path else "N/A"
            return Trial(ordinal, run_id, definition, {}, "success", path, None, model)
        except Exception as error:
            if fail_fast:
                raise TrainingError(f"model {definition.name!r} failed: {error}") from error
            return Trial(ordinal, run_id, definition, {}, "failed", "N/A", str(error))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        trials = list(pool.map(inheritable_thread_target(slice_.sparkSession)(attempt), items))
    _score(held, [t for t in trials if t.model is not None], metrics, fail_fast)
    return trials


def _slices(train: DataFrame, validation: DataFrame, features: Sequence[str], target: str) -> tuple[DataFrame, DataFrame]:
    return train.select(*features, target).persist(StorageLevel.MEMORY_AND_DISK), validation.select(*features, F.col(target).cast("double").alias("label"))


def search(
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    target: str = "total_load",
    definitions: Sequence[ModelDefinition] = DEFAULT_MODELS,
    metrics: Sequence[str] = DEFAULT_METRICS,
    models_path: str | None = None,
    parallelism: int = 4,
    fail_fast: bool = False,
    strategy: str = "grid",
    max_trials: int | None = None,
    halving: Halving | None = None,
    trials_path: str | None = None,
) -> list[Trial]:
    """Fit definitions on ``train`` and score them on ``validation``.

    "grid" tries them in order and "random" a drawn sample, up to ``max_trials``; "halving" gives rounds to the better ones (see
    `halving_search`). The fits are independent Spark jobs over one persisted slice and run side by side. A failed fit is
    recorded and skipped, or raised with ``fail_fast``.
    """
    chosen = choose(definitions, strategy, max_trials)
    if strategy == "halving":
        return halving_search(
            train, validation, features, target, chosen, halving or Halving(), metrics, models_path, parallelism, trials_path
        )
    slice_, held = _slices(train, validation, features, target)
    try:
        return _attempts(slice_, held, features, target, list(enumerate(chosen)), metrics, models_path, parallelism, fail_fast)
    finally:
        slice_.unpersist()


@dataclass(frozen=True)
class Halving:
    """Rounds (trees) that all fits may take together, the share of trials that goes on (one in ``eta``), and the metric that decides."""

    budget: int = 1000
    eta: int = 3
    metric: str = "rmse"

    def rungs(self, trials: int) -> list[tuple[int, int]]:
        """Trials and most rounds of each, rung by rung. Each rung has an equal part of the budget."""
        if self.eta < 2 or trials < 1:
            raise OptionError(f"halving needs eta of at least 2 and a trial, not {self.eta} and {trials}")
        sizes = [trials]
        while sizes[-1] > 1:
            sizes.append(-(-sizes[-1] // self.eta))
        if self.budget < len(sizes) * trials:
            raise OptionError(f"a budget of {self.budget} rounds is too small for {trials} trials over {len(sizes)} rungs")
        return [(n, self.budget // len(sizes) // n) for n in sizes]


#: Kinds whose fit is a number of trees; the others are fitted in full, as one round.
ROUND_KINDS = {"random_forest_regressor", "random_forest_classifier", "gradient_boosting", "xgboost", "lightgbm"}
RUNG_SCHEMA = T.StructType([T.StructField("search_id", T.StringType()), T.StructField("rung", T.IntegerType()), T.StructField("rounds", T.IntegerType()), *TRIAL_SCHEMA])


def rounds_of(definition: ModelDefinition, most: int) -> int:
    """Rounds of a definition in a rung: what it declares, at most ``most``."""
    return min(int(definition.params.get("n_estimators", 100)), most) if definition.kind in ROUND_KINDS else 1


def survivors(scores: Mapping[int, float], n: int) -> list[int]:
    """The ``n`` ordinals with the lowest scores, the earlier first in ties; those without a finite score never go on."""
    usable = [(value, ordinal) for ordinal, value in scores.items() if math.isfinite(value)]
    return sorted(ordinal for _, ordinal in sorted(usable)[:n])


def halving_search(
    train: DataFrame, validation: DataFrame, features: Sequence[str], target: str = "total_load", definitions: Sequence[ModelDefinition] = DEFAULT_MODELS,
    halving: Halving = Halving(), metrics: Sequence[str] = DEFAULT_METRICS, models_path: str | None = None, parallelism: int = 4, trials_path: str | None = None,
) -> list[Trial]:
    """Successive halving: all trials get few rounds, the better ones go on with more, within a budget of rounds.

    Every trial is given back as of its last rung; those that did not go on have the status "stopped", so the best trial is one
    of the last rung. With ``trials_path`` (and ``models_path``) each finished rung is appended to a table, and a search with the same
    definitions, budget and features goes on behind the rungs that it finds there. A trial that has had all its rounds is not fitted again.
    """
    spark = train.sparkSession
    told = json.dumps([[[d.name, d.kind, {k: str(v) for k, v in sorted(d.params.items())}] for d in definitions], halving.budget, halving.eta, halving.metric, [*features], target])
    search_id = hashlib.sha256(told.encode()).hexdigest()
    done: dict[int, dict[int, Any]] = {}
    if trials_path:
        if not models_path:
            raise OptionError("a table of trials needs a place for their models")
        for row in read_table(spark, trials_path, RUNG_SCHEMA).where(F.col("search_id") == search_id).collect():
            done.setdefault(row["rung"], {})[row["ordinal"]] = row
    slice_, held = _slices(train, validation, features, target)
    last: dict[int, tuple[Trial, int]] = {}
    going = list(range(len(definitions)))
    try:
        rungs = halving.rungs(len(definitions))
        for rung, (n, most) in enumerate(rungs):
            if rung:
                going = survivors({k: last[k][0].metrics.get(halving.metric, math.inf) for k in going}, n)
            rounds = {k: rounds_of(definitions[k], most) for k in going}
            if set(done.get(rung, ())) >= set(going):
                for k in going:
                    row = done[rung][k]
                    last[k] = Trial(k, row["run_id"], definitions[k], dict(row["metrics"] or {}), row["status"], row["model_path"], row["error_message"]), row["rounds"]
                continue
            fresh = [k for k in going if k not in last or last[k][1] < rounds[k]]
            cut = {k: replace(definitions[k], params={**definitions[k].params, "n_estimators": rounds[k]}) if definitions[k].kind in ROUND_KINDS else definitions[k] for k in fresh}
            for trial in _attempts(slice_, held, features, target, list(cut.items()), metrics, models_path, parallelism, False):
                last[trial.ordinal] = replace(trial, definition=definitions[trial.ordinal]), rounds[trial.ordinal]
            if trials_path:
                append_rows(spark, trials_path, [(search_id, rung, last[k][1], *last[k][0].row()) for k in going], RUNG_SCHEMA)
    finally:
        slice_.unpersist()
    final = set(going)
    out = []
    for k in sorted(last):
        trial = last[k][0]
        if trial.status == "success" and k not in final:
            trial = replace(trial, status="stopped")
        elif trial.status == "success" and trial.model is None:
            trial = replace(trial, model=load_model(trial.model_path))
        out.append(trial)
    return out


def trial_table(spark, trials: Sequence[Trial]) -> DataFrame:
    return spark.createDataFrame([t.row() for t in trials], TRIAL_SCHEMA)


def best_trial(trials: Sequence[Trial], metric: str = "rmse") -> Trial:
    """Lowest metric among the trials that have one; the earlier wins ties; none left is an error."""
    scored = [t for t in trials if t.status == "success" and t.metrics.get(metric, float("nan")) < float("inf")]
    if not scored:
        raise TrainingError("every trial failed")
    return min(scored, key=lambda t: (t.metrics[metric], t.ordinal))
