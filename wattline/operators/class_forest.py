"""Forests of classification trees over cells.

A tree sees its rows only through their number per vector of bins and class, so one aggregation shrinks any number of rows to cells. In a bootstrap
sample where every row counts a Poisson(1) number of times, the m rows of a cell and class together count a Poisson(m) number of times:
samples are drawn for cells, and have the distribution that draws for single rows have.

A split's gain is what it takes from the Gini impurity. As in Spark's trees, two leaves of one parent that predict the same class become one,
and trees vote with the shares of the classes in their leaves.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.errors import TrainingError
from wattline.operators.boosting import MOST_GRID, Growth, Tree
from wattline.operators.cells import Binning, find_bins
from wattline.storage import materialize

#: Numbers of the histograms that are held at a time.
HELD_NUMBERS = 4_000_000
#: Gains below this share of a node's rows are what rounding leaves.
NOISE = 1e-12


def split_features(value: Any, count: int, trees: int) -> int | None:
    """Features that a split may use, by the names and rounding of Spark's forests; None is all."""
    value = str(value)
    if value == "auto":
        value = "sqrt" if trees > 1 else "all"
    named = {"all": count, "None": count, "onethird": count / 3, "sqrt": math.sqrt(count), "log2": math.log2(count)}
    number = named[value] if value in named else float(value) * (count if "." in value else 1)
    chosen = max(1, math.ceil(number))
    return chosen if chosen < count else None


def class_cells(df: DataFrame, binning: Binning, target: str) -> DataFrame:
    """One written row per cell and class: its bins, ``kind`` (the class as text) and ``n``. A class or feature that is missing, and an empty table, is an error."""
    names = [f"b{k}" for k in range(len(binning.features))]
    bins = [binning.column(k).cast("int").alias(b) for k, b in enumerate(names)]
    cells = df.select(*bins, F.col(f"`{target}`").cast("string").alias("kind")).groupBy(*names, "kind").agg(F.count(F.lit(1)).alias("n"))
    cells = materialize(cells, "class-cells")
    lacking = F.col("kind").isNull()
    for k, b in enumerate(names):
        lacking = lacking | (F.col(b) == binning.missing(k))
    told = cells.agg(F.sum("n").alias("n"), F.sum(F.when(lacking, F.col("n"))).alias("lacking")).first()
    if not told["n"]:
        raise TrainingError("no rows to train on")
    if told["lacking"]:
        raise TrainingError(f"{told['lacking']} rows lack a feature or {target!r}")
    return cells


def _histograms(bins: np.ndarray, counts: np.ndarray, slot: np.ndarray, nodes: int, width: int) -> np.ndarray:
    """Rows by (node, feature, bin, class)."""
    features, classes = bins.shape[1], counts.shape[1]
    places = ((slot[:, None] * features + np.arange(features)) * width + bins).ravel()
    sums = [np.bincount(places, np.repeat(counts[:, c], features), nodes * features * width) for c in range(classes)]
    return np.stack(sums, -1).reshape(nodes, features, width, classes)


def _squares(counts: np.ndarray) -> np.ndarray:
    """Sum of the squared counts over their total: the rows less their Gini impurity."""
    n = counts.sum(axis=-1)
    return np.divide((counts * counts).sum(axis=-1), n, out=np.zeros_like(n), where=n > 0)


def _splits(hist: np.ndarray, allowed: np.ndarray, growth: Growth) -> list[tuple[float, int, int] | None]:
    """For each node the split with the largest gain: (gain, feature, cut). Equal gains: the first feature, the lowest cut."""
    left = np.cumsum(hist, axis=2)
    whole = left[:, :, -1:, :]
    right = whole - left
    n, n_left, n_right = (x.sum(axis=-1) for x in (whole, left, right))
    fits = allowed[:, :, None] & (np.minimum(n_left, n_right) >= max(growth.min_rows, 1.0)) & (n >= growth.min_split_rows)
    gains = np.where(fits, _squares(left) + _squares(right) - _squares(whole), -np.inf).reshape(len(hist), -1)
    top = gains.max(axis=1)
    first = np.argmax(gains >= (top - NOISE * n[:, 0, 0])[:, None], axis=1)
    return [(g, *divmod(at, hist.shape[2])) if g > NOISE * rows else None for g, at, rows in zip(top.tolist(), first.tolist(), n[:, 0, 0].tolist(), strict=True)]


def grow_class_tree(bins: np.ndarray, counts: np.ndarray, growth: Growth, draw: np.random.Generator) -> tuple[Tree, list[list[float]]]:
    """A tree on cells (bins, rows by class), level by level, and the rows by class in each of its nodes."""
    tree, features, width = Tree(), bins.shape[1], int(bins.max()) + 1
    node = np.full(len(bins), tree.add(float(counts.sum()), 0.0))
    held, level = [counts.sum(axis=0)], [0]
    at_once = max(1, HELD_NUMBERS // (features * width * counts.shape[1]))
    for _ in range(growth.max_depth if growth.max_depth is not None else len(bins)):
        fresh = []
        for begin in range(0, len(level), at_once):
            part = level[begin : begin + at_once]
            rows = np.flatnonzero((node >= part[0]) & (node <= part[-1]))
            hist = _histograms(bins[rows], counts[rows], node[rows] - part[0], len(part), width)
            allowed = np.ones((len(part), features), bool)
            if growth.features_per_split:
                for one in allowed:
                    one[draw.permutation(features)[growth.features_per_split :]] = False
            for k, split in enumerate(_splits(hist, allowed, growth)):
                if split is None:
                    continue
                at = part[k]
                tree.gain[at], tree.feature[at], tree.cut[at] = split
                left = hist[k, tree.feature[at], : tree.cut[at] + 1].sum(axis=0)
                for side, own in (("left", left), ("right", held[at] - left)):
                    child = tree.add(float(own.sum()), 0.0)
                    getattr(tree, side)[at] = child
                    held.append(own)
                    fresh.append(child)
        if not fresh:
            break
        feature, cut, to_left, to_right = (np.array(x) for x in (tree.feature, tree.cut, tree.left, tree.right))
        moving = np.flatnonzero(feature[node] >= 0)
        at = node[moving]
        node[moving] = np.where(bins[moving, feature[at]] <= cut[at], to_left[at], to_right[at])
        level = fresh
    best = [int(np.argmax(own)) for own in held]
    # children come behind their parents
    for at in reversed(range(len(held))):
        left, right = tree.left[at], tree.right[at]
        if tree.feature[at] >= 0 and tree.feature[left] < 0 and tree.feature[right] < 0 and best[left] == best[right]:
            tree.feature[at] = tree.left[at] = tree.right[at] = -1
    return tree, [own.tolist() for own in held]


@dataclass
class ClassForest:
    """Trees over binned features that vote; ``counts`` has the rows by class of each node of each tree. Equal votes: the first class."""

    FORMAT = "wattline.ClassForest"

    binning: Binning
    classes: list[str]
    trees: list[Tree]
    counts: list[list[list[float]]]

    def predict_bins(self, bins: np.ndarray) -> np.ndarray:
        """The number of the class of each row of a matrix of bins."""
        missing = np.array([self.binning.missing(k) for k in range(len(self.binning.features))], np.int64)
        votes = np.zeros((len(bins), len(self.classes)))
        for tree, counts in zip(self.trees, self.counts, strict=True):
            own = np.array(counts, float)
            shares = own / np.maximum(own.sum(axis=1, keepdims=True), 1e-300)
            votes += shares[tree.leaf_of(bins, missing)]
        return np.argmax(votes, axis=1)

    def column(self) -> Column:
        """The predicted class. Few possible vectors of bins are tabulated, and scoring is a lookup in the JVM; else Arrow batches run the trees."""
        bins = [self.binning.column(k).cast("int") for k in range(len(self.binning.features))]
        sizes = [len(c) + 2 for c in self.binning.cuts]
        if self.binning.grid <= MOST_GRID:
            place = F.lit(0)
            for size, one in zip(sizes, bins, strict=True):
                place = place * F.lit(size) + one
            grid = np.stack(np.meshgrid(*[np.arange(n) for n in sizes], indexing="ij"), -1).reshape(-1, len(sizes))
            number = F.get(F.from_json(F.lit(json.dumps(self.predict_bins(grid).tolist())), "array<int>"), place)
        else:
            model = self

            @F.pandas_udf("int")
            def run(*columns):
                import pandas as pd

                return pd.Series(model.predict_bins(np.stack([c.to_numpy(np.int64) for c in columns], 1)))

            number = run(*bins)
        lacking = F.lit(False)
        for k, one in enumerate(bins):
            lacking = lacking | (one == self.binning.missing(k))
        named = F.get(F.from_json(F.lit(json.dumps(self.classes)), "array<string>"), number)
        return F.when(lacking, F.raise_error(F.lit("a row lacks a feature")).cast("string")).otherwise(named)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the column ``prediction``. No shuffle."""
        return df.withColumn("prediction", self.column())

    def to_json(self) -> str:
        trees = [{k: list(getattr(t, k)) for k in ("feature", "cut", "missing_left", "left", "right", "value", "gain", "rows")} for t in self.trees]
        return json.dumps({"features": self.binning.features, "cuts": self.binning.cuts, "classes": self.classes, "trees": trees, "counts": self.counts})

    @classmethod
    def from_json(cls, text: str) -> ClassForest:
        told = json.loads(text)
        binning = Binning(tuple(told["features"]), tuple(tuple(c) for c in told["cuts"]))
        return cls(binning, told["classes"], [Tree(**t) for t in told["trees"]], told["counts"])


def fit_class_forest(
    train: DataFrame, features: Sequence[str], target: str, growth: Growth, trees: int, max_bins: int, bootstrap: bool, seed: int, most_cells: int
) -> ClassForest | None:
    """A forest on the cells of each tree's bootstrap sample, or of all rows. None where cells, classes and trees are more than ``most_cells`` numbers.

    The rows are read three times, however many trees: for the bins twice and for the cells once. Classes are numbered by their rows, most first.
    """
    binning = find_bins(train, features, max_bins)
    cells = class_cells(train, binning, target)
    names = [f"b{k}" for k in range(len(features))]
    order = [r["kind"] for r in cells.groupBy("kind").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "kind").limit(most_cells + 1).collect()]
    if cells.select(*names).distinct().count() * len(order) * trees > most_cells:
        return None
    held = cells.orderBy(*names, "kind").toPandas()
    bins, index = np.unique(held[names].to_numpy(np.int64), axis=0, return_inverse=True)
    counts = np.zeros((len(bins), len(order)))
    number = {kind: k for k, kind in enumerate(order)}
    counts[index.ravel(), held["kind"].map(number).to_numpy()] = held["n"].to_numpy(float)
    grown = []
    for k in range(trees if bootstrap or growth.features_per_split else 1):
        draw = np.random.default_rng([seed, k])
        sample = draw.poisson(counts).astype(float) if bootstrap else counts
        some = sample.any(axis=1)
        # a sample of few rows may be empty, as all of its draws may miss them: then all rows are taken
        grown.append(grow_class_tree(bins[some], sample[some], growth, draw) if some.any() else grow_class_tree(bins, counts, growth, draw))
    grown *= trees if len(grown) < trees else 1
    return ClassForest(binning, order, [t for t, _ in grown], [c for _, c in grown])
