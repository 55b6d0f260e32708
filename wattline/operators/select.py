"""Choosing the best trial and the champion. All are combinable aggregates: no sort, no window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row(df: DataFrame, by: Sequence[str]) -> Column:
    return F.struct(*[c for c in df.columns if c not in by])


def usable(metric: str) -> Column:
    value = F.col(metric)
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def select_best(trials: DataFrame, metric: str = "rmse", order: str = "ordinal", by: Sequence[str] = ()) -> DataFrame:
    """Lowest finite metric; the earlier trial wins a tie. Groups without a usable trial give no row."""
    best = F.min_by(_row(trials, by), F.struct(metric, order))
    return trials.where(usable(metric)).groupBy(*by).agg(best.alias("_best")).where("_best is not null").select(*by, "_best.*")


def select_best_lenient(
    trials: DataFrame, metric: str = "rmse", order: str = "ordinal", by: Sequence[str] = ()
) -> DataFrame:
    """A trial without the metric counts as infinitely bad instead of being left out."""
    score = F.coalesce(F.col(metric), F.lit(float("inf")))
    best = F.min_by(_row(trials, by), F.struct(score.alias("_score"), F.col(order)))
    return trials.groupBy(*by).agg(best.alias("_best")).where("_best is not null").select(*by, "_best.*")


def champion_vs_baseline(
    candidates: DataFrame,
    metric: str = "rmse",
    order: str = "ordinal",
    is_baseline: str = "is_baseline",
    by: Sequence[str] = (),
) -> DataFrame:
    """The best candidate strictly below the baseline, else the baseline.

    Both come out of one aggregation: the best candidate overall beats the baseline exactly
    when any candidate does.
    """
    row = _row(candidates, by)
    rival = F.min_by(row, F.when(~F.col(is_baseline) & usable(metric), F.struct(metric, order)))
    base = F.min_by(row, F.when(F.col(is_baseline), F.col(order)))
    both = candidates.groupBy(*by).agg(rival.alias("_rival"), base.alias("_base"))
    wins = F.coalesce(F.col(f"_rival.{metric}") < F.col(f"_base.{metric}"), F.lit(False))
    return (
        both.where("_base is not null")
        .select(*by, F.when(wins, F.col("_rival")).otherwise(F.col("_base")).alias("_best"))
        .select(*by, "_best.*")
    )
