"""Model quality from (label, prediction) rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.errors import OptionError, TrainingError


def mse(label: Column | None = None, guess: Column | None = None) -> Column:
    label = F.col("label") if label is None else label
    guess = F.col("prediction") if guess is None else guess
    return F.avg(F.pow(label - guess, 2))


def rmse(label: Column | None = None, guess: Column | None = None) -> Column:
    return F.sqrt(mse(label, guess))


METRICS = {"rmse": rmse, "mse": mse}
# Metric list and warning thresholds.
DEFAULT_METRICS = ("rmse", "mse")
DEFAULT_THRESHOLDS = {"rmse": 20_000.0, "mse": 500_000_000.0}


def _known(metrics: Sequence[str]) -> None:
    unknown = [m for m in metrics if m not in METRICS]
    if unknown:
        raise OptionError(f"unknown metrics {unknown}; known: {sorted(METRICS)}")


def evaluate(
    predictions: DataFrame, by: Sequence[str | Column] = (), metrics: Sequence[str] = DEFAULT_METRICS
) -> DataFrame:
    """One row per group with the row count, the unusable rows, and each metric.

    All models are judged in one pass with partial sums, over the rows with usable label and prediction. The others are
    counted; :func:`evaluate_one` refuses them.
    """
    _known(metrics)
    label, guess = F.col("label").cast("double"), F.col("prediction").cast("double")
    broken = label.isNull() | guess.isNull() | F.isnan(label) | F.isnan(guess)
    return predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(broken).alias("n_broken"),
        *[METRICS[m](F.when(~broken, label), F.when(~broken, guess)).alias(m) for m in metrics],
    )


def evaluate_one(predictions: DataFrame, metrics: Sequence[str] = DEFAULT_METRICS) -> dict[str, float]:
    """Metrics of one model as a dictionary; empty or broken input is an error."""
    row = evaluate(predictions, (), metrics).first()
    if row["n_rows"] == 0 or row["n_broken"]:
        raise TrainingError(f"cannot evaluate: {row['n_rows']} rows, {row['n_broken']} without usable value")
    return {m: float(row[m]) for m in metrics}


def metrics_long(wide: DataFrame, keys: Sequence[str], metrics: Sequence[str] = DEFAULT_METRICS) -> DataFrame:
    """(keys, metric, value) from one column per metric."""
    return wide.unpivot(list(keys), list(metrics), "metric", "value")


def lookup(metric: Column, values: Mapping[str, float]) -> Column:
    """Value configured for the metric, NULL when none is; a literal map, so no join."""
    pairs = [F.lit(x) for name, v in values.items() for x in (name, float(v))]
    return F.try_element_at(F.create_map(*pairs), metric) if pairs else F.lit(None).cast("double")


def threshold_breaches(long: DataFrame, thresholds: Mapping[str, float] = DEFAULT_THRESHOLDS) -> DataFrame:
    """Adds ``threshold`` and ``exceeded``; equal to the threshold is not above it. No threshold: no row."""
    return (
        long.withColumn("threshold", lookup(F.col("metric"), thresholds))
        .where(F.col("threshold").isNotNull())
        .withColumn("exceeded", F.coalesce(F.col("value") > F.col("threshold"), F.lit(False)))
    )


def metric_violations(
    trials: DataFrame, required: Sequence[str] = DEFAULT_METRICS, model: str = "model_name", metrics: str = "metrics"
) -> DataFrame:
    """Unsound metrics of each model: (model, metric, value, kind).

    Kinds: ``missing`` (required, absent), ``not_finite`` (NULL, NaN or infinite), ``negative`` (rmse below zero).
    """
    entries = F.map_entries(metrics)
    absent = F.filter(
        F.array(*[F.lit(m) for m in required]), lambda m: ~F.map_contains_key(F.col(metrics), m)
    )
    missing = F.transform(
        absent, lambda m: F.struct(m.alias("metric"), F.lit(None).cast("double").alias("value"), F.lit("missing").alias("kind"))
    )

    def kind(entry: Column) -> Column:
        value = entry["value"]
        finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
        return F.when(~finite, F.lit("not_finite")).when((entry["key"] == "rmse") & (value < 0), F.lit("negative"))

    unsound = F.filter(
        F.transform(
            entries,
            lambda e: F.struct(e["key"].alias("metric"), e["value"].alias("value"), kind(e).alias("kind")),
        ),
        lambda v: v["kind"].isNotNull(),
    )
    return trials.select(model, F.inline(F.concat(missing, unsound)))
