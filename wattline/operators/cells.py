"""Training rows as sufficient statistics: one row per distinct binned feature vector.

Trees see a feature only through the order of its bins, and squared error sees the rows of one cell only through their
count, the sum and the sum of squares of the label. So one combinable aggregation shrinks any number of rows to the cells
they fall into; calendar features have a few hundred, however long the series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.errors import TrainingError
from wattline.storage import materialize

#: Accuracy of the quantiles that cut a feature with more values than bins: ranks are off by at most one in so many rows.
QUANTILE_ACCURACY = 10_000


@dataclass(frozen=True)
class Binning:
    """Ascending cuts per feature. A value's bin is the number of cuts below it; a missing one has the bin behind all."""

    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]

    def missing(self, feature: int) -> int:
        return len(self.cuts[feature]) + 1

    @property
    def grid(self) -> int:
        """Number of vectors of bins that can be."""
        return math.prod(len(c) + 2 for c in self.cuts)

    def column(self, feature: int) -> Column:
        """The bin as a JVM expression: a binary search unrolled to comparisons."""
        value = F.col(f"`{self.features[feature]}`").cast("double")
        cuts = self.cuts[feature]

        def search(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            middle = (low + high) // 2
            return F.when(value <= F.lit(cuts[middle]), search(low, middle)).otherwise(search(middle + 1, high))

        return F.when(value.isNull() | F.isnan(value), F.lit(self.missing(feature))).otherwise(search(0, len(cuts)))


def _midpoints(values: Sequence[float]) -> tuple[float, ...]:
    ordered = sorted(values)
    found = []
    for low, high in zip(ordered, ordered[1:], strict=False):
        middle = low + (high - low) / 2
        found.append(middle if low <= middle < high else low)
    return tuple(found)


def find_bins(df: DataFrame, features: Sequence[str], max_bins: int = 255) -> Binning:
    """Cuts between all values of features with at most ``max_bins`` values, at quantiles of the others.

    Two passes: sketches of all features together, then the values of those that may have few. Values that
    are missing or not finite are in no cut; infinite ones fall into the outer bins.
    """
    numbers = [F.col(f"`{f}`").cast("double") for f in features]
    finite = [F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x) for x in numbers]
    shares = F.array(*[F.lit(k / max_bins) for k in range(1, max_bins)])
    sketches = df.agg(
        *[F.approx_count_distinct(x).alias(f"d{k}") for k, x in enumerate(finite)],
        *[F.percentile_approx(x, shares, QUANTILE_ACCURACY).alias(f"q{k}") for k, x in enumerate(finite)],
    ).first()
    maybe_few = [k for k in range(len(features)) if sketches[f"d{k}"] <= 2 * max_bins]
    few: dict[int, list[float]] = {k: [] for k in maybe_few}
    if maybe_few:
        pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), finite[k].alias("x")) for k in maybe_few])).alias("p")
        # at most about 2 * max_bins values of each feature, by the sketch
        for row in df.select(pairs).select("p.*").where("x is not null").distinct().collect():
            few[row["k"]].append(row["x"])
    cuts = []
    for k in range(len(features)):
        if k in few and len(few[k]) <= max_bins:
            cuts.append(_midpoints(few[k]))
        else:
            cuts.append(tuple(sorted(set(sketches[f"q{k}"]))))
    return Binning(tuple(features), tuple(cuts))


def bin_rows(df: DataFrame, binning: Binning, target: str) -> DataFrame:
    """Bins ``b0, b1, ...`` and the label ``y`` of each row."""
    bins = [binning.column(k).cast("int").alias(f"b{k}") for k in range(len(binning.features))]
    return df.select(*bins, F.col(f"`{target}`").cast("double").alias("y"))


def cell_table(df: DataFrame, binning: Binning, target: str, missing_allowed: bool) -> DataFrame:
    """One written row per cell: its bins, ``n``, ``s`` (sum of the label) and ``q`` (of its square).

    A label that is missing or not finite is an error, as is a missing feature unless allowed, and an empty table.
    """
    names = [f"b{k}" for k in range(len(binning.features))]
    sums = [F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q")]
    broken = F.count_if(F.col("y").isNull() | F.isnan("y") | (F.abs("y") == F.lit(float("inf")))).alias("broken")
    cells = materialize(bin_rows(df, binning, target).groupBy(*names).agg(*sums, broken), "cells")
    lacking = [F.col(f"b{k}") == binning.missing(k) for k in range(len(names))]
    any_lacking = F.lit(False)
    for one in lacking:
        any_lacking = any_lacking | one
    told = cells.agg(F.sum("n").alias("n"), F.sum("broken").alias("broken"), F.sum(F.when(any_lacking, F.col("n")).otherwise(0)).alias("lacking")).first()
    if not told["n"]:
        raise TrainingError("no rows to train on")
    if told["broken"]:
        raise TrainingError(f"{target!r}: {told['broken']} labels are missing or not finite")
    if told["lacking"] and not missing_allowed:
        raise TrainingError(f"{int(told['lacking'])} rows lack a feature")
    return cells.drop("broken")
