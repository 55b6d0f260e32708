"""Elastic nets from one Gram matrix.

Squared error sees the rows only through n, the sums of features and label, X'X, X'y and y'y. They come from one distributed pass: tasks
sum products of their rows, Spark adds the sums up. Any number of penalties is then solved by cyclic coordinate descent on these numbers, and
judged on the same numbers of another slice, without a scan per trial.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.errors import OptionError, TrainingError

#: Features up to which a task holds all products as one matrix (8 bytes each). Beyond, only products that are not 0 are kept and sent.
DENSE_FEATURES = 1024
#: Rows whose mean is subtracted from all, so that large values do not cancel; any values give the same result.
SHIFT_ROWS = 1000
#: Products that are not 0 which the driver takes.
MOST_PRODUCTS = 50_000_000


@dataclass
class Gram:
    """Sums over rows. ``x`` and ``y`` are shifted by ``shift``; X'X is kept by columns (borders, rows, values)."""

    features: tuple[str, ...]
    n: float
    x: np.ndarray
    y: float
    yy: float
    xy: np.ndarray
    borders: np.ndarray
    rows: np.ndarray
    values: np.ndarray
    shift: np.ndarray

    def column(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.borders[j], self.borders[j + 1])
        return self.rows[at], self.values[at]

    def product(self, w: np.ndarray) -> np.ndarray:
        """X'X w."""
        columns = np.repeat(np.arange(len(w)), np.diff(self.borders))
        return np.bincount(self.rows, self.values * w[columns], len(w))


def gram(df: DataFrame, features: Sequence[str], target: str) -> Gram:
    """The sums of a table. No rows, and values that are missing or not finite, are an error."""
    k = len(features)
    numbers = df.select(*[F.col(f"`{f}`").cast("double").alias(f"x{j}") for j, f in enumerate(features)], F.col(f"`{target}`").cast("double").alias("y"))
    dense = k <= DENSE_FEATURES
    shift = np.zeros(k + 1)
    if dense:
        head = numbers.limit(SHIFT_ROWS).agg(*[F.avg(c).alias(c) for c in numbers.columns]).first()
        shift = np.array([head[c] if head[c] is not None and math.isfinite(head[c]) else 0.0 for c in numbers.columns])
    # the columns of the product: features, label, and a column of ones
    width = k + 2

    def run(batches) -> Iterator:
        import pyarrow as pa

        def rows_of(sums: np.ndarray, places: np.ndarray):
            i, j = np.nonzero(sums)
            return pa.RecordBatch.from_arrays([pa.array(places[i] * width + places[j]), pa.array(sums[i, j])], ["place", "v"])

        every = np.arange(width)
        total = np.zeros((width, width) if dense else (0, 0))
        broken = 0
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], 1) - shift
            fine = np.isfinite(x).all(axis=1)
            broken += int((~fine).sum())
            x = np.column_stack([x[fine], np.ones(int(fine.sum()))])
            if dense:
                total += x.T @ x
                continue
            some = np.flatnonzero(x.any(axis=0))
            part = x[:, some]
            yield rows_of(part.T @ part, some)
        if dense:
            yield rows_of(total, every)
        # behind the matrix: the number of rows that cannot be used
        yield pa.RecordBatch.from_arrays([pa.array([width * width]), pa.array([float(broken)])], ["place", "v"])

    sums = numbers.mapInArrow(run, "place long, v double").groupBy("place").agg(F.sum("v").alias("v"))
    if not dense:
        sums = sums.persist()
        if sums.count() > MOST_PRODUCTS:
            raise TrainingError(f"{k} features have more than {MOST_PRODUCTS} products that are not 0")
    found = sums.toPandas()
    place, value = found["place"].to_numpy(np.int64), found["v"].to_numpy(float)
    if value[place == width * width].sum():
        raise TrainingError(f"{int(value[place == width * width].sum())} rows have values that are missing or not finite")
    inside = place < width * width
    i, j, value = *np.divmod(place[inside], width), value[inside]
    lookup = dict(zip(zip(i[j >= k].tolist(), j[j >= k].tolist(), strict=True), value[j >= k].tolist(), strict=True))
    n = lookup.get((k + 1, k + 1), 0.0)
    if not n:
        raise TrainingError("no rows to train on")
    body = (i < k) & (j < k)
    order = np.lexsort((i[body], j[body]))
    borders = np.searchsorted(j[body][order], np.arange(k + 1))
    return Gram(
        tuple(features), n, np.array([lookup.get((a, k + 1), 0.0) for a in range(k)]), lookup.get((k, k + 1), 0.0), lookup.get((k, k), 0.0),
        np.array([lookup.get((a, k), 0.0) for a in range(k)]), borders, i[body][order], value[body][order], shift,
    )


@dataclass
class LinearNet:
    """A fitted linear model; it scores in the JVM."""

    FORMAT = "wattline.LinearNet"

    features: tuple[str, ...]
    coefficients: list[float]
    intercept: float
    sweeps: int = 0

    @property
    def stages(self) -> list[LinearNet]:
        """As a pipeline of one stage."""
        return [self]

    def column(self) -> Column:
        out = F.lit(self.intercept)
        for name, weight in zip(self.features, self.coefficients, strict=True):
            if weight:
                out = out + F.lit(weight) * F.col(f"`{name}`").cast("double")
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the column ``prediction``. No shuffle."""
        return df.withColumn("prediction", self.column())

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "coefficients": self.coefficients, "intercept": self.intercept, "sweeps": self.sweeps})

    @classmethod
    def from_json(cls, text: str) -> LinearNet:
        told = json.loads(text)
        return cls(tuple(told["features"]), told["coefficients"], told["intercept"], told["sweeps"])


def solve(g: Gram, alpha: float, l1_ratio: float, fit_intercept: bool = True, max_iter: int = 1000, tol: float = 1e-9, start: Sequence[float] | None = None) -> LinearNet:
    """Minimise 1/(2n)|y - Xw - b|^2 + alpha*l1_ratio*|w|_1 + alpha*(1-l1_ratio)/2*|w|^2 by cyclic coordinate descent.

    A sweep ends the descent when no coefficient moved predictions by more than ``tol`` of the label's deviation. A feature that is constant
    has coefficient 0.
    """
    if alpha < 0 or not 0 <= l1_ratio <= 1:
        raise OptionError(f"alpha {alpha} must not be negative, l1_ratio {l1_ratio} lies between 0 and 1")
    k = len(g.features)
    # without an intercept the shift has to be undone, with one it drops out
    if not fit_intercept and g.shift.any():
        raise OptionError("a fit without intercept needs a Gram matrix without shift")
    mean = g.x / g.n if fit_intercept else np.zeros(k)
    mean_y = g.y / g.n if fit_intercept else 0.0
    variance = np.array([g.column(j)[1][g.column(j)[0] == j].sum() for j in range(k)]) / g.n - mean**2
    scale = math.sqrt(max(g.yy / g.n - mean_y**2, 0.0))
    w = np.zeros(k) if start is None else np.array(start, float)
    # gradient of the smooth part, with its sign changed: X'(y - Xw) / n of the centred columns
    left = g.xy / g.n - mean * mean_y - (g.product(w) / g.n - mean * float(mean @ w))
    first, second = alpha * l1_ratio, alpha * (1.0 - l1_ratio)
    # what rounding leaves of a constant column is no variance
    moves = variance > 1e-14 * (variance + mean**2)
    sweeps = 0
    while sweeps < max_iter:
        sweeps += 1
        widest = 0.0
        for j in range(k):
            if not moves[j]:
                continue
            pull = left[j] + variance[j] * w[j]
            fresh = math.copysign(max(abs(pull) - first, 0.0), pull) / (variance[j] + second)
            step = fresh - w[j]
            if step:
                rows, values = g.column(j)
                left[rows] -= step * values / g.n
                left += step * mean[j] * mean
                w[j] = fresh
                widest = max(widest, abs(step) * math.sqrt(variance[j]))
        if widest <= tol * scale:
            break
    intercept = float(mean_y - mean @ w + g.shift[k] - g.shift[:k] @ w) if fit_intercept else 0.0
    return LinearNet(g.features, w.tolist(), intercept, sweeps)


def mean_squared_error(g: Gram, model: LinearNet) -> float:
    """The error of a model on the rows behind ``g``, from its sums alone."""
    w = np.array(model.coefficients)
    # on shifted columns the intercept is another one
    b = model.intercept - g.shift[-1] + float(g.shift[:-1] @ w)
    total = g.yy - 2 * float(w @ g.xy) - 2 * b * g.y + float(w @ g.product(w)) + 2 * b * float(w @ g.x) + g.n * b * b
    return max(total / g.n, 0.0)


def net_path(g: Gram, alphas: Sequence[float], l1_ratio: float, **options) -> list[LinearNet]:
    """Models for falling penalties, each started from the one before; given back in the order of ``alphas``."""
    found: dict[float, LinearNet] = {}
    start = None
    for alpha in sorted(set(alphas), reverse=True):
        found[alpha] = solve(g, alpha, l1_ratio, start=start, **options)
        start = found[alpha].coefficients
    return [found[a] for a in alphas]
