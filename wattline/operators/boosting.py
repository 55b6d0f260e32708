"""Boosted trees and forests over cells, by second-order histograms.

A tree is grown from histograms of gradient, hessian and row count per (leaf, feature, bin). They are one combinable aggregation over
the cells: few cells are held by the driver as arrays, more stay a distributed table, of which each task sums its own cells and Spark adds
the sums up. Of two sibling leaves only the one with fewer rows is aggregated; the other one is the difference to their parent. The split search sees histograms
alone, so both ways grow the same trees.

Leaves are split best first. The children of all leaves that wait for it are aggregated in one pass, so a tree takes
about as many passes as it has levels. ``max_leaves`` bounds a leaf-wise tree, ``max_depth`` a level-wise one; without a bound on leaves the
order does not matter.

With the loss (prediction - y)^2 / 2 a row has the gradient prediction - y and the hessian 1. A split's gain is
``L(left) + L(right) - L(parent)`` with ``L = soft(G, alpha)^2 / (H + lambda)``, a leaf's value ``-soft(G, alpha) / (H + lambda)``. Rows without the feature
go to the side with the larger gain; where a leaf has none, to the side with more rows. Equal gains: the first feature, the lowest cut.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.operators.cells import Binning, bin_rows, cell_table, find_bins
from wattline.storage import materialize

#: Cells that the driver holds as arrays; more stay distributed.
MOST_CELLS = 200_000
#: Vectors of bins whose predictions are tabulated, so that scoring is a lookup.
MOST_GRID = 65_536
#: Gains below this share of the labels' squares are what rounding leaves.
NOISE = 1e-24
#: Rounds after which a distributed fit writes its predictions anew.
ROUNDS_PER_WRITE = 10


@dataclass(frozen=True)
class Growth:
    """How trees grow. ``min_gain`` is subtracted from each gain, which must then be above 0."""

    max_depth: int | None = None
    max_leaves: int | None = None
    min_rows: float = 1.0
    min_split_rows: float = 2.0
    min_hessian: float = 0.0
    reg_lambda: float = 0.0
    reg_alpha: float = 0.0
    min_gain: float = 0.0
    #: Share of the features that each tree, or each split, may use.
    features_per_tree: float = 1.0
    features_per_split: int | None = None


@dataclass
class Tree:
    """Nodes in arrays; ``feature`` is -1 in leaves. Bins up to ``cut`` go left, missing ones where ``missing_left`` says."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    rows: list[float] = field(default_factory=list)

    def add(self, rows: float, value: float) -> int:
        for name, at in (("feature", -1), ("cut", -1), ("missing_left", False), ("left", -1), ("right", -1), ("value", value), ("gain", 0.0), ("rows", rows)):
            getattr(self, name).append(at)
        return len(self.feature) - 1

    def leaf_of(self, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """Leaf of each row of a matrix of bins."""
        feature, cut, left, right = (np.array(x, np.int64) for x in (self.feature, self.cut, self.left, self.right))
        missing_left = np.array(self.missing_left, bool)
        node = np.zeros(len(bins), np.int64)
        open_ = np.arange(len(bins)) if len(feature) and feature[0] >= 0 else np.empty(0, np.int64)
        while len(open_):
            at = node[open_]
            f = feature[at]
            b = bins[open_, f]
            goes_left = np.where(b == missing[f], missing_left[at], b <= cut[at])
            node[open_] = np.where(goes_left, left[at], right[at])
            open_ = open_[feature[node[open_]] >= 0]
        return node

    def predict(self, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
        return np.array(self.value, float)[self.leaf_of(bins, missing)]


def soft(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def _score(g: np.ndarray, h: np.ndarray, growth: Growth) -> np.ndarray:
    below = h + growth.reg_lambda
    drawn = soft(g, growth.reg_alpha) if growth.reg_alpha else g
    return np.divide(drawn * drawn, below, out=np.zeros_like(below), where=below > 0)


def leaf_value(g: float, h: float, growth: Growth) -> float:
    below = h + growth.reg_lambda
    return float(-soft(np.float64(g), growth.reg_alpha) / below) if below > 0 else 0.0


def best_splits(hist: np.ndarray, missing: np.ndarray, allowed: np.ndarray, growth: Growth, noise: float = 0.0) -> list[tuple | None]:
    """For each leaf the split with the largest gain: (gain, feature, cut, missing goes left).

    ``hist`` is (leaf, feature, bin, 3): gradient, hessian, rows; a feature's missing bin is ``missing[f]``. ``allowed`` is (leaf, feature).
    Gains up to ``noise`` are no gains.
    """
    leaves, features, bins, _ = hist.shape
    f = np.arange(features)
    absent = hist[:, f, missing, :]
    present = hist.copy()
    present[:, f, missing, :] = 0.0
    upto = np.cumsum(present, axis=2)
    whole = upto[:, :, -1, :] + absent
    base = _score(whole[..., 0], whole[..., 1], growth)[:, :, None]
    # a cut behind the last bin parts the present from the missing
    real = (np.arange(bins)[None, :] < missing[:, None])[None] & allowed[:, :, None]
    gains = np.full((2, leaves, features, bins), -np.inf)
    # the missing right, then left; left cuts behind the last bin part nothing
    for side, left in enumerate((upto, upto + absent[:, :, None, :])):
        right = whole[:, :, None, :] - left
        fits = real & (left[..., 2] >= growth.min_rows) & (right[..., 2] >= growth.min_rows) & (left[..., 2] > 0) & (right[..., 2] > 0.5)
        fits &= (whole[:, :, None, 2] >= growth.min_split_rows) & (left[..., 1] >= growth.min_hessian) & (right[..., 1] >= growth.min_hessian)
        gain = _score(left[..., 0], left[..., 1], growth) + _score(right[..., 0], right[..., 1], growth) - base
        gains[side] = np.where(fits, gain, -np.inf)
    best = gains.max(axis=0)
    flat = best.reshape(leaves, -1)
    top = flat.max(axis=1)
    # gains that differ by rounding alone are equal, and the first one counts
    first = np.argmax(flat >= (top * (1 - 1e-12))[:, None], axis=1)
    found: list[tuple | None] = []
    for leaf, (most, at) in enumerate(zip(top.tolist(), first.tolist(), strict=True)):
        if not most - growth.min_gain > noise:
            found.append(None)
            continue
        feature, cut = divmod(at, bins)
        if absent[leaf, feature, 2] > 0:
            goes_left = bool(gains[1, leaf, feature, cut] > gains[0, leaf, feature, cut])
        else:
            # nothing is missing and both sides are equal: the one with more rows
            goes_left = bool(2 * upto[leaf, feature, cut, 2] > whole[leaf, feature, 2])
        found.append((most - growth.min_gain, feature, cut, goes_left))
    return found


class HeldCells:
    """Cells as arrays of the driver; at most ``MOST_CELLS``."""

    def __init__(self, bins: np.ndarray, n: np.ndarray, s: np.ndarray, shape: tuple[int, int], missing: np.ndarray, root: np.ndarray | None = None):
        self.bins, self.n, self.s, self.shape, self.missing = bins, n, s, shape, missing
        #: The root of the tree that a cell belongs to, where several grow together.
        self.root = np.zeros(len(n), np.int64) if root is None else root
        self.prediction = np.zeros(len(n))
        self.energy = float((s * s / n).sum()) if len(n) else 0.0
        self.places = bins + np.arange(shape[0]) * shape[1]

    def sums(self) -> tuple[float, float]:
        return float(self.n.sum()), float(self.s.sum())

    def start(self, value: float) -> None:
        self.prediction[:] = value

    def begin(self, tree: Tree) -> None:
        self.node = self.root.copy()
        self.gradient = self.prediction * self.n - self.s

    def split(self, tree: Tree, at: Sequence[int]) -> None:
        """Move the cells of nodes that have got children."""
        feature, cut, missing_left, left, right = (np.array(x) for x in (tree.feature, tree.cut, tree.missing_left, tree.left, tree.right))
        fresh = np.zeros(len(feature), bool)
        fresh[list(at)] = True
        rows = np.flatnonzero(fresh[self.node])
        node = self.node[rows]
        f = feature[node]
        b = self.bins[rows, f]
        goes_left = np.where(b == self.missing[f], missing_left[node], b <= cut[node])
        self.node[rows] = np.where(goes_left, left[node], right[node])

    def histograms(self, tree: Tree, at: Sequence[int]) -> np.ndarray:
        features, bins = self.shape
        slot = np.full(len(tree.feature), -1, np.int64)
        slot[list(at)] = np.arange(len(at))
        leaf = slot[self.node]
        rows = np.flatnonzero(leaf >= 0)
        places, size = (self.places[rows] + (leaf[rows] * features * bins)[:, None]).ravel(), len(at) * features * bins
        gradient, n = (np.bincount(places, np.repeat(x[rows], features), size) for x in (self.gradient, self.n))
        return np.stack([gradient, n, n], -1).reshape(len(at), features, bins, 3)

    def finish(self, tree: Tree) -> None:
        self.prediction += tree.predict(self.bins, self.missing)


class SpreadCells:
    """Cells as a distributed table with the prediction so far; tasks sum histograms of their cells, Spark adds them up.

    Trees are kept by the driver. A pass applies those that are not in the table yet, at most ``ROUNDS_PER_WRITE``.
    """

    def __init__(self, cells: DataFrame, shape: tuple[int, int], missing: np.ndarray):
        self.names = [f"b{k}" for k in range(shape[0])]
        self.cells, self.shape, self.missing = cells.select(*self.names, "n", "s", F.lit(0.0).alias("p")), shape, missing
        self.trees: list[Tree] = []
        self.first = 0.0
        self.energy = float(cells.agg(F.sum(F.col("s") * F.col("s") / F.col("n"))).first()[0])

    def sums(self) -> tuple[float, float]:
        return tuple(self.cells.agg(F.sum("n"), F.sum("s")).first())

    def start(self, value: float) -> None:
        self.first = value

    def begin(self, tree: Tree) -> None:
        pass

    def split(self, tree: Tree, at: Sequence[int]) -> None:
        pass

    def _context(self):
        names, missing, trees, first = list(self.names), self.missing, list(self.trees), self.first

        def read(batch):
            bins = np.stack([batch.column(c).to_numpy() for c in names], 1).astype(np.int64)
            n, s, p = (batch.column(c).to_numpy() for c in ("n", "s", "p"))
            p = p + first
            for done in trees:
                p = p + done.predict(bins, missing)
            return bins, n, s, p

        return read

    def histograms(self, tree: Tree, at: Sequence[int]) -> np.ndarray:
        read, missing, (features, bins) = self._context(), self.missing, self.shape
        place = np.full(len(tree.feature), -1, np.int64)
        place[list(at)] = np.arange(len(at))

        def run(batches) -> Iterator:
            import pyarrow as pa

            size = len(at) * features * bins
            total = np.zeros((size, 3))
            for batch in batches:
                cells, n, s, p = read(batch)
                leaf = place[tree.leaf_of(cells, missing)]
                rows = np.flatnonzero(leaf >= 0)
                where = ((leaf[rows, None] * features + np.arange(features)) * bins + cells[rows]).ravel()
                for j, x in enumerate((p * n - s, n, n)):
                    total[:, j] += np.bincount(where, np.repeat(x[rows], features), size)
            some = np.flatnonzero(total[:, 2])
            yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(total[some, j]) for j in range(3))], ["place", "g", "h", "c"])

        parts = self.cells.mapInArrow(run, "place long, g double, h double, c double")
        sums = parts.groupBy("place").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("c").alias("c")).toPandas()
        out = np.zeros((len(at) * features * bins, 3))
        out[sums["place"].to_numpy()] = sums[["g", "h", "c"]].to_numpy()
        return out.reshape(len(at), features, bins, 3)

    def finish(self, tree: Tree) -> None:
        self.trees.append(tree)
        if len(self.trees) < ROUNDS_PER_WRITE:
            return
        read, names = self._context(), self.names

        def run(batches) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*names, "n", "s")), pa.array(read(batch)[3])], [*names, "n", "s", "p"])

        self.cells = materialize(self.cells.mapInArrow(run, self.cells.schema), "boosted")
        self.trees, self.first = [], 0.0


def _usable(features: int, growth: Growth, draw: np.random.Generator | None) -> np.ndarray:
    """Features that one tree may use."""
    out = np.ones(features, bool)
    if growth.features_per_tree < 1:
        out[:] = False
        out[draw.choice(features, max(1, round(growth.features_per_tree * features)), replace=False)] = True
    return out


def _allowed(usable: np.ndarray, growth: Growth, draw: np.random.Generator | None) -> np.ndarray:
    """Features that each split may use, of those its tree may (leaf, feature)."""
    if growth.features_per_split and growth.features_per_split < usable.shape[1]:
        usable = usable.copy()
        for row in usable:
            row[draw.permutation(np.flatnonzero(row))[growth.features_per_split :]] = False
    return usable


def _open_children(tree: Tree, node: int, split: tuple, hist: np.ndarray, missing: np.ndarray) -> tuple[int, int, bool]:
    """Write a split down; its children, and whether the left one has no more rows."""
    tree.gain[node], tree.feature[node], tree.cut[node], tree.missing_left[node] = split
    rows = hist[tree.feature[node], :, 2]
    left_rows = rows[: tree.cut[node] + 1].sum() + (rows[missing[tree.feature[node]]] if tree.missing_left[node] else 0.0)
    tree.left[node], tree.right[node] = tree.add(0.0, 0.0), tree.add(0.0, 0.0)
    return tree.left[node], tree.right[node], bool(2 * left_rows <= rows.sum())


def _sibling(parent: np.ndarray, hist: np.ndarray) -> np.ndarray:
    other = parent - hist
    # what subtraction leaves of bins without rows is no gradient
    other[other[..., 2] < 0.5] = 0.0
    return other


def _describe(tree: Tree, nodes: Sequence[int], hists: np.ndarray, growth: Growth, rate: float) -> None:
    sums = hists[:, 0].sum(axis=1)
    for node, (g, h, c) in zip(nodes, sums.tolist(), strict=True):
        tree.rows[node], tree.value[node] = c, rate * leaf_value(g, h, growth)


def grow_levels(cells: HeldCells | SpreadCells, growth: Growth, rate: float = 1.0, draw: np.random.Generator | None = None, roots: int = 1) -> list[Tree]:
    """Trees on the gradients that ``cells`` have, level by level; several grow in the same passes. Leaf values are scaled by ``rate``."""
    tree = Tree()
    cells.begin(tree)
    nodes = [tree.add(0.0, 0.0) for _ in range(roots)]
    usable = np.stack([_usable(cells.shape[0], growth, draw) for _ in nodes])
    hists = cells.histograms(tree, nodes)
    depth, chosen = 0, set()
    while nodes:
        _describe(tree, nodes, hists, growth, rate)
        if growth.max_depth is not None and depth >= growth.max_depth:
            break
        splits = best_splits(hists, cells.missing, _allowed(usable, growth, draw), growth, NOISE * cells.energy)
        at = [k for k, split in enumerate(splits) if split]
        if not at:
            break
        parts = [_open_children(tree, nodes[k], splits[k], hists[k], cells.missing) for k in at]
        fresh = [nodes[k] for k in at]
        chosen.update(fresh)
        cells.split(tree, fresh)
        small = cells.histograms(tree, [left if less else right for left, right, less in parts])
        large = _sibling(hists[at], small)
        less = np.array([p[2] for p in parts])[:, None, None, None]
        hists = np.stack([np.where(less, small, large), np.where(less, large, small)], 1).reshape(-1, *small.shape[1:])
        nodes = [child for left, right, _ in parts for child in (left, right)]
        usable = np.repeat(usable[at], 2, axis=0)
        depth += 1
    return [_pruned(tree, chosen, root) for root in range(roots)]


def grow_tree(cells: HeldCells | SpreadCells, growth: Growth, rate: float = 1.0, draw: np.random.Generator | None = None) -> Tree:
    """One tree on the gradients that ``cells`` have: level by level, or best first with a bound on leaves."""
    if growth.max_leaves is None:
        return grow_levels(cells, growth, rate, draw)[0]
    tree = Tree()
    cells.begin(tree)
    usable = _usable(cells.shape[0], growth, draw)[None]
    hists = {tree.add(0.0, 0.0): cells.histograms(tree, [0])[0]}
    depth, splits, children = {0: 0}, {}, {}

    def judge(nodes: list[int]) -> None:
        stacked = np.stack([hists[k] for k in nodes])
        _describe(tree, nodes, stacked, growth, rate)
        found = best_splits(stacked, cells.missing, _allowed(np.repeat(usable, len(nodes), axis=0), growth, draw), growth, NOISE * cells.energy)
        for node, split in zip(nodes, found, strict=True):
            if split and (growth.max_depth is None or depth[node] < growth.max_depth):
                splits[node] = split

    judge([0])
    queue = [(-splits[0][0], 0)] if splits else []
    chosen: set[int] = set()
    while queue and len(chosen) < growth.max_leaves - 1:
        if queue[0][1] not in children:
            # the children of every leaf in the queue, in one pass; some may not be needed in the end
            fresh = [node for _, node in sorted(queue) if node not in children]
            small = []
            for node in fresh:
                left, right, less = _open_children(tree, node, splits[node], hists[node], cells.missing)
                children[node] = left, right
                depth[left] = depth[right] = depth[node] + 1
                small.append(left if less else right)
            cells.split(tree, fresh)
            for node, less, hist in zip(fresh, small, cells.histograms(tree, small), strict=True):
                left, right = children[node]
                hists[less], hists[right if less == left else left] = hist, _sibling(hists.pop(node), hist)
            judge([child for node in fresh for child in children[node]])
        node = heapq.heappop(queue)[1]
        chosen.add(node)
        for child in children[node]:
            if child in splits:
                heapq.heappush(queue, (-splits[child][0], child))
    return _pruned(tree, chosen)


def _pruned(tree: Tree, chosen: set[int], root: int = 0) -> Tree:
    """The tree of the chosen splits below ``root`` alone, its nodes numbered anew."""
    out = Tree()
    stack = [(root, out.add(tree.rows[root], tree.value[root]))]
    while stack:
        old, new = stack.pop()
        if old not in chosen:
            continue
        for name in ("feature", "cut", "missing_left", "gain"):
            getattr(out, name)[new] = getattr(tree, name)[old]
        out.left[new], out.right[new] = (out.add(tree.rows[k], tree.value[k]) for k in (tree.left[old], tree.right[old]))
        stack += [(tree.right[old], out.right[new]), (tree.left[old], out.left[new])]
    return out


def _shape(binning: Binning) -> tuple[tuple[int, int], np.ndarray]:
    missing = np.array([binning.missing(k) for k in range(len(binning.features))], np.int64)
    return (len(missing), int(missing.max()) + 1), missing


def open_cells(cells: DataFrame, binning: Binning, most_cells: int = MOST_CELLS) -> HeldCells | SpreadCells:
    """The cells as arrays if their count allows, else as a table."""
    shape, missing = _shape(binning)
    if cells.count() > most_cells:
        return SpreadCells(cells, shape, missing)
    names = [f"b{k}" for k in range(shape[0])]
    held = cells.orderBy(*names).toPandas()
    return HeldCells(held[names].to_numpy(np.int64), held["n"].to_numpy(float), held["s"].to_numpy(float), shape, missing)


@dataclass
class EnsembleModel:
    """Trees over binned features. The prediction is ``base`` plus the sum of all trees, or their mean."""

    FORMAT = "wattline.EnsembleModel"

    binning: Binning
    trees: list[Tree]
    base: float
    average: bool = False

    def predict_bins(self, bins: np.ndarray) -> np.ndarray:
        _, missing = _shape(self.binning)
        total = np.zeros(len(bins))
        for tree in self.trees:
            total += tree.predict(bins, missing)
        return self.base + (total / max(1, len(self.trees)) if self.average else total)

    def _tabulated(self) -> np.ndarray:
        sizes = [len(c) + 2 for c in self.binning.cuts]
        grid = np.stack(np.meshgrid(*[np.arange(n) for n in sizes], indexing="ij"), -1).reshape(-1, len(sizes))
        return self.predict_bins(grid)

    def column(self) -> Column:
        """The prediction as an expression. Few possible vectors of bins are tabulated, and scoring is a lookup in the JVM; else Arrow batches run the trees."""
        count = len(self.binning.features)
        bins = [self.binning.column(k).cast("int") for k in range(count)]
        if self.binning.grid <= MOST_GRID:
            place = F.lit(0)
            for k in range(count):
                place = place * F.lit(len(self.binning.cuts[k]) + 2) + bins[k]
            # one literal, whatever its length: a constant that is folded once
            table = F.from_json(F.lit(json.dumps(self._tabulated().tolist())), "array<double>")
            return F.get(table, place)
        model = self

        @F.pandas_udf("double")
        def run(*columns):
            import pandas as pd

            return pd.Series(model.predict_bins(np.stack([c.to_numpy(np.int64) for c in columns], 1)))

        return run(*bins)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the column ``prediction``. No shuffle."""
        return df.withColumn("prediction", self.column())

    def to_json(self) -> str:
        trees = [{k: list(getattr(t, k)) for k in ("feature", "cut", "missing_left", "left", "right", "value", "gain", "rows")} for t in self.trees]
        return json.dumps({"features": self.binning.features, "cuts": self.binning.cuts, "base": self.base, "average": self.average, "trees": trees})

    @classmethod
    def from_json(cls, text: str) -> EnsembleModel:
        told = json.loads(text)
        binning = Binning(tuple(told["features"]), tuple(tuple(c) for c in told["cuts"]))
        return cls(binning, [Tree(**t) for t in told["trees"]], told["base"], told["average"])


def boost(cells: HeldCells | SpreadCells, binning: Binning, growth: Growth, rounds: int, rate: float, seed: int = 42, init: str = "mean") -> EnsembleModel:
    """Trees one after the other on what the ones before leave. The first prediction is the mean; with ``init`` "tree" the first tree is the
    first prediction, and so is not scaled."""
    n, s = cells.sums()
    base = 0.0 if init == "tree" else s / n
    cells.start(base)
    draw = np.random.default_rng(seed)
    drawn = growth.features_per_tree < 1 or growth.features_per_split is not None
    trees = []
    for k in range(rounds):
        tree = grow_tree(cells, growth, 1.0 if init == "tree" and not k else rate, draw)
        trees.append(tree)
        if len(tree.feature) == 1 and not drawn and tree.value[0] ** 2 * n <= NOISE * cells.energy:
            # nothing is left to fit, and no draw could change it
            break
        cells.finish(tree)
    return EnsembleModel(binning, trees, base)


def fit_boosted(
    train: DataFrame, features: Sequence[str], target: str, growth: Growth, rounds: int, rate: float, max_bins: int = 255, missing_allowed: bool = False,
    seed: int = 42, init: str = "mean", most_cells: int = MOST_CELLS,
) -> EnsembleModel:
    """Boosted trees for squared error. The rows are read three times in all: for the bins twice and for the cells once."""
    binning = find_bins(train, features, max_bins)
    cells = cell_table(train, binning, target, missing_allowed)
    return boost(open_cells(cells, binning, most_cells), binning, growth, rounds, rate, seed, init)


def bagged_cells(rows: DataFrame, binning: Binning, trees: int, seed: int) -> DataFrame:
    """``place`` (of a vector of bins), ``tree``, ``n``, ``s``: each cell in each tree's bootstrap sample, where every row counts a Poisson(1) number of times.

    One pass: a task draws for its rows and sums per cell and tree, Spark adds the sums up. ``rows`` has bins and ``y``. The draws follow
    the layout of the table: the same files give the same samples.
    """
    names = [f"b{k}" for k in range(len(binning.features))]
    sizes = [len(c) + 2 for c in binning.cuts]

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        draw = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            place = np.ravel_multi_index([batch.column(c).to_numpy() for c in names], sizes)
            known, index = np.unique(place, return_inverse=True)
            n, s = np.zeros((len(known), trees)), np.zeros((len(known), trees))
            weights = draw.poisson(1.0, (len(y), trees)).astype(float)
            order = np.argsort(index, kind="stable")
            if len(order):
                starts = np.searchsorted(index[order], np.arange(len(known)))
                n, s = np.add.reduceat(weights[order], starts), np.add.reduceat(weights[order] * y[order, None], starts)
            at, tree = np.nonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(known[at]), pa.array(tree.astype(np.int32)), pa.array(n[at, tree]), pa.array(s[at, tree])], ["place", "tree", "n", "s"])

    parts = rows.mapInArrow(run, "place long, tree int, n double, s double")
    return parts.groupBy("place", "tree").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


#: Trees of a forest that grow in the same passes.
TREES_AT_ONCE = 50


def grow_forest(binning: Binning, cells: HeldCells | SpreadCells, growth: Growth, seed: int, roots: int = 1) -> EnsembleModel:
    """The mean of one tree per root of ``cells``; a tree predicts the mean label of its leaf."""
    cells.start(0.0)
    return EnsembleModel(binning, grow_levels(cells, growth, 1.0, np.random.default_rng(seed), roots), 0.0, average=True)


def fit_forest(
    train: DataFrame, features: Sequence[str], target: str, growth: Growth, trees: int, max_bins: int = 255, bootstrap: bool = True, seed: int = 42, most_cells: int = MOST_CELLS
) -> EnsembleModel | None:
    """A forest on the cells of each tree's bootstrap sample, or of all rows. None where these are more than ``most_cells`` numbers."""
    binning = find_bins(train, features, max_bins)
    cells = cell_table(train, binning, target, missing_allowed=False)
    drawn = growth.features_per_split is not None
    if not bootstrap:
        held = open_cells(cells, binning, most_cells)
        # without draws all trees are the same
        grown = [grow_forest(binning, held, growth, seed + k).trees[0] for k in range(trees if drawn else 1)]
        return EnsembleModel(binning, grown if drawn else grown * trees, 0.0, average=True)
    if binning.grid >= 1 << 62 or cells.count() * trees > most_cells:
        return None
    (shape, missing), sizes = _shape(binning), [len(c) + 2 for c in binning.cuts]
    bagged = bagged_cells(bin_rows(train, binning, target), binning, trees, seed).orderBy("tree", "place").toPandas()
    place, tree, n, s = (bagged[c].to_numpy() for c in ("place", "tree", "n", "s"))
    bins = np.stack(np.unravel_index(place, sizes), 1)
    # a sample of few rows may be empty, as all of its draws may miss them: it predicts the mean of all
    mean = s.sum() / n.sum() if len(n) else float(cells.agg(F.sum("s") / F.sum("n")).first()[0])
    grown = []
    for begin in range(0, trees, TREES_AT_ONCE):
        end = min(trees, begin + TREES_AT_ONCE)
        rows = (tree >= begin) & (tree < end)
        held = HeldCells(bins[rows], n[rows], s[rows], shape, missing, tree[rows].astype(np.int64) - begin)
        grown += grow_forest(binning, held, growth, seed + begin, end - begin).trees
    for one in grown:
        if not one.rows[0]:
            one.value[0] = mean
    return EnsembleModel(binning, grown, 0.0, average=True)
