"""Trees on cells against brute force over rows."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from wattline.errors import OptionError, TrainingError
from wattline.operators import boosting, cells
from wattline.operators.boosting import EnsembleModel, Growth, HeldCells, fit_boosted, fit_forest
from wattline.operators.models import ModelDefinition, fit, load_model, save_model

NAN = float("nan")


def draw_rows(seed=1, n=400, missing=True):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, c = draw.randint(0, 6), draw.choice([0.5, 1.5, 7.0]), float(draw.randint(0, 3))
        y = 3.0 * (a > 3) - 2.0 * (b > 1) * (c > 1) + 0.1 * a * c + draw.random() * 0.2
        if missing and draw.random() < 0.15:
            a, y = None, y + 4.0
        if missing and draw.random() < 0.1:
            c = draw.choice([None, NAN])
        rows.append((a, b, c, y))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "a long, b double, c double, y double").repartition(3)


def lacking(x):
    return x is None or x != x


def score(rows, g, lam, alpha):
    total = sum(g[k] for k in rows)
    return max(abs(total) - alpha, 0) ** 2 / (len(rows) + lam) if rows else 0.0


def brute_best(data, rows, g, growth):
    """The best split of ``rows``: (gain, feature, value up to which goes left, missing goes left)."""
    best = None
    if len(rows) < growth.min_split_rows:
        return None
    for f in range(len(data[0]) - 1):
        values = sorted({data[k][f] for k in rows if not lacking(data[k][f])})
        absent = [k for k in rows if lacking(data[k][f])]
        for value, side in itertools.product(values, (False, True)):
            left = [k for k in rows if (side if lacking(data[k][f]) else data[k][f] <= value)]
            chosen = set(left)
            right = [k for k in rows if k not in chosen]
            if min(len(left), len(right)) < max(1, growth.min_rows, growth.min_hessian):
                continue
            gain = score(left, g, growth.reg_lambda, growth.reg_alpha) + score(right, g, growth.reg_lambda, growth.reg_alpha) - score(rows, g, growth.reg_lambda, growth.reg_alpha) - growth.min_gain
            if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                best = gain, f, value, side, not absent
    return best


def check_tree(tree, binning, data, g, growth):
    """Every split of a tree is as good as the best one by brute force, every leaf has its value, and no leaf could be split further."""
    stack, leaves = [(0, list(range(len(data))), 0)], 0
    while stack:
        node, rows, depth = stack.pop()
        best = brute_best(data, rows, g, growth) if growth.max_depth is None or depth < growth.max_depth else None
        if tree.feature[node] < 0:
            leaves += 1
            total = sum(g[k] for k in rows)
            value = -math.copysign(max(abs(total) - growth.reg_alpha, 0), total) / (len(rows) + growth.reg_lambda)
            assert tree.value[node] == pytest.approx(value, abs=1e-9) and tree.rows[node] == len(rows)
            if growth.max_leaves is None:
                assert best is None
            continue
        f, cuts = tree.feature[node], binning.cuts[tree.feature[node]]
        limit = cuts[tree.cut[node]] if tree.cut[node] < len(cuts) else float("inf")
        left = [k for k in rows if (tree.missing_left[node] if lacking(data[k][f]) else data[k][f] <= limit)]
        right = sorted(set(rows) - set(left))
        gain = score(left, g, growth.reg_lambda, growth.reg_alpha) + score(right, g, growth.reg_lambda, growth.reg_alpha) - score(rows, g, growth.reg_lambda, growth.reg_alpha) - growth.min_gain
        assert gain == pytest.approx(best[0], rel=1e-8) == pytest.approx(tree.gain[node], rel=1e-8)
        stack += [(tree.left[node], left, depth + 1), (tree.right[node], right, depth + 1)]
    return leaves


GROWTHS = [
    Growth(max_depth=3), Growth(max_depth=4, reg_lambda=1.0, min_hessian=5.0, min_gain=0.5), Growth(max_depth=2, reg_alpha=3.0, reg_lambda=0.5), Growth(max_leaves=7, min_rows=20.0),
    Growth(max_leaves=12, min_rows=3.0, max_depth=5), Growth(), Growth(min_split_rows=60.0),
]


@pytest.mark.parametrize("most", [0, 1000])
@pytest.mark.parametrize("growth", GROWTHS)
def test_splits_equal_brute_force(spark, growth, most):
    rows = draw_rows()
    model = fit_boosted(table(spark, rows), ["a", "b", "c"], "y", growth, 2, 0.3, missing_allowed=True, most_cells=most)
    base = sum(r[3] for r in rows) / len(rows)
    assert model.base == pytest.approx(base)
    g = [base - r[3] for r in rows]
    for tree in model.trees:
        for name in ("value",):
            setattr(tree, name, [v / 0.3 for v in getattr(tree, name)])
        leaves = check_tree(tree, model.binning, rows, g, growth)
        if growth.max_leaves:
            assert leaves == growth.max_leaves
        bins = np.array([[sum(x > c for c in cut) if not lacking(x) else len(cut) + 1 for x, cut in zip(r[:3], model.binning.cuts, strict=True)] for r in rows])
        step = tree.predict(bins, np.array([len(c) + 1 for c in model.binning.cuts]))
        g = [x + 0.3 * s for x, s in zip(g, step, strict=True)]


def test_leaf_wise_takes_the_best_leaf_first(spark):
    rows = draw_rows(4)
    whole = fit_boosted(table(spark, rows), ["a", "b", "c"], "y", Growth(min_rows=5.0), 1, 1.0, missing_allowed=True).trees[0]
    for leaves in (2, 3, 5, 9):
        tree = fit_boosted(table(spark, rows), ["a", "b", "c"], "y", Growth(min_rows=5.0, max_leaves=leaves), 1, 1.0, missing_allowed=True).trees[0]
        queue, expected = [(whole.gain[0], 0)], []
        for _ in range(leaves - 1):
            queue.sort()
            gain, node = queue.pop()
            expected.append(gain)
            queue += [(whole.gain[k], k) for k in (whole.left[node], whole.right[node]) if whole.feature[k] >= 0]
        found = [g for g, f in zip(tree.gain, tree.feature, strict=True) if f >= 0]
        assert sorted(found) == pytest.approx(sorted(expected))


def test_spread_cells_grow_the_same_trees(spark, monkeypatch):
    monkeypatch.setattr(boosting, "ROUNDS_PER_WRITE", 2)
    rows = draw_rows(2)
    for growth in (Growth(max_leaves=6), Growth(max_depth=3, reg_lambda=1.0)):
        held, spread = (fit_boosted(table(spark, rows), ["a", "b", "c"], "y", growth, 5, 0.2, missing_allowed=True, most_cells=m) for m in (1000, 0))
        for one, other in zip(held.trees, spread.trees, strict=True):
            assert (one.feature, one.cut, one.missing_left) == (other.feature, other.cut, other.missing_left)
            assert one.value == pytest.approx(other.value)


@pytest.mark.parametrize("grid", [0, 65_536])
def test_scoring_equals_the_trees(spark, monkeypatch, grid):
    monkeypatch.setattr(boosting, "MOST_GRID", grid)
    rows = draw_rows(3)
    model = fit_boosted(table(spark, rows), ["a", "b", "c"], "y", Growth(max_leaves=8), 6, 0.3, missing_allowed=True)
    edge = [(None, None, None, 0.0), (99, -5.0, NAN, 0.0), (-9, float("inf"), float("-inf"), 0.0), *rows]
    scored = model.transform(spark.createDataFrame(edge, "a long, b double, c double, y double"))
    assert scored.columns == ["a", "b", "c", "y", "prediction"] and ("Python" in plan_of(scored)) == (not grid)
    for r in scored.collect():
        bins = np.array([[len(c) + 1 if lacking(x) else sum(x > cut for cut in c) for x, c in zip(r[:3], model.binning.cuts, strict=True)]])
        assert r.prediction == pytest.approx(float(model.predict_bins(bins)[0]), abs=1e-12)
    again = EnsembleModel.from_json(model.to_json())
    assert again == model


def test_full_trees_shrink_towards_the_cell_means(spark):
    """With a leaf per cell each round takes the same share of what is left: mean + (cell mean - mean) * (1 - (1 - rate)^rounds)."""
    rows = draw_rows(5, missing=False)
    df = table(spark, rows)
    for kind, params in (("gradient_boosting", {"max_depth": 30}), ("lightgbm", {"num_leaves": 500, "min_child_samples": 1}), ("xgboost", {"max_depth": 0, "reg_lambda": 0})):
        model = fit(ModelDefinition("m", kind, {"n_estimators": 40, "learning_rate": 0.05, **params}), df, ["a", "b", "c"], "y")
        mean, share = sum(r[3] for r in rows) / len(rows), 1 - 0.95**40
        for r in model.transform(df.groupBy("a", "b", "c").agg(F.avg("y").alias("m"))).collect():
            assert r.prediction == pytest.approx(mean + (r.m - mean) * share)


def test_forest(spark):
    rows = draw_rows(6, 3000, missing=False)
    df = table(spark, rows)
    whole = fit_forest(df, ["a", "b", "c"], "y", Growth(), 3, bootstrap=False)
    cell = df.groupBy("a", "b", "c").agg(F.avg("y").alias("m"), F.count(F.lit(1)).alias("n"))
    assert all(r.prediction == pytest.approx(r.m) for r in whole.transform(cell).collect())
    bagged = fit_forest(df, ["a", "b", "c"], "y", Growth(), 300, most_cells=1 << 30)
    # the mean of bootstrap means of a cell is near its mean, and no two trees are the same
    assert all(r.prediction == pytest.approx(r.m, abs=0.05 + 1 / r.n) for r in bagged.transform(cell).collect())
    assert len({tuple(t.value) for t in bagged.trees}) == 300
    again = fit_forest(df, ["a", "b", "c"], "y", Growth(), 300, most_cells=1 << 30)
    assert [t.value for t in again.trees] == [t.value for t in bagged.trees]
    few = fit_forest(df, ["a", "b", "c"], "y", Growth(features_per_split=1, max_depth=2), 20, most_cells=1 << 30)
    assert {t.feature[0] for t in few.trees} == {0, 1, 2}
    assert fit_forest(df, ["a", "b", "c"], "y", Growth(), 20, most_cells=10) is None


def test_bagged_cells_have_poisson_counts(spark):
    rows = [(1, 0.0, 0.0, 2.0)] * 500 + [(2, 0.0, 0.0, 1.0)] * 100
    df = table(spark, rows)
    binning = cells.find_bins(df, ["a"])
    drawn = boosting.bagged_cells(cells.bin_rows(df, binning, "y"), binning, 200, 1)
    found = {r.place: r for r in drawn.groupBy("place").agg(F.avg("n").alias("n"), F.var_pop("n").alias("v"), F.max(F.abs(F.col("s") / F.col("n"))).alias("m")).collect()}
    assert found[0].n == pytest.approx(500, abs=8) and found[0].v == pytest.approx(500, rel=0.4) and found[0].m == 2.0
    assert found[1].n == pytest.approx(100, abs=4) and found[1].m == 1.0


def test_bins(spark):
    df = spark.createDataFrame([(float(k % 1000), k % 3, NAN if k % 2 else None) for k in range(5000)], "x double, z int, n double")
    binning = cells.find_bins(df, ["x", "z", "n"], 16)
    assert binning.cuts[1] == (0.5, 1.5) and binning.cuts[2] == () and len(binning.cuts[0]) == 15
    counts = [r["count"] for r in cells.bin_rows(df.withColumn("y", F.lit(0.0)), binning, "y").groupBy("b0").count().collect()]
    assert len(counts) == 16 and max(counts) < 1.2 * min(counts)
    # neighbours in floating point have no number between them
    odd = spark.createDataFrame([(1.0,), (math.nextafter(1.0, 2.0),), (float("inf"),), (float("-inf"),)], "x double")
    assert cells.find_bins(odd, ["x"]).cuts == ((1.0,),)
    assert sorted(r.b0 for r in cells.bin_rows(odd.withColumn("y", F.lit(0.0)), cells.find_bins(odd, ["x"]), "y").collect()) == [0, 0, 1, 1]


def test_unusable_rows(spark):
    good = table(spark, draw_rows(7, 50, missing=False))
    for bad in (None, NAN, float("inf")):
        with pytest.raises(TrainingError, match="not finite"):
            fit(ModelDefinition("m", "xgboost", {}), good.union(spark.createDataFrame([(1, 1.0, 1.0, bad)], good.schema)), ["a"], "y")
    with pytest.raises(TrainingError, match="no rows"):
        fit(ModelDefinition("m", "lightgbm", {}), good.limit(0), ["a"], "y")
    with pytest.raises(TrainingError, match="lack a feature"):
        fit(ModelDefinition("m", "gradient_boosting", {}), table(spark, draw_rows(7)), ["a"], "y")
    with pytest.raises(OptionError):
        fit(ModelDefinition("m", "lightgbm", {"leaves": 3}), good, ["a"], "y")
    with pytest.raises(OptionError):
        fit(ModelDefinition("m", "xgboost", {"max_leaves": 3}), good, ["a"], "y")


def test_constant_labels_and_one_cell(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, 5.0)] * 30, "a long, b double, c double, y double")
    for kind in ("gradient_boosting", "xgboost", "lightgbm", "random_forest_regressor"):
        model = fit(ModelDefinition("m", kind, {"n_estimators": 3}), df, ["a", "b"], "y")
        assert [r.prediction for r in model.transform(df).distinct().collect()] == pytest.approx([5.0])


def test_saved_models(spark, tmp_path):
    df = table(spark, draw_rows(8))
    model = fit(ModelDefinition("m", "lightgbm", {"n_estimators": 4}), df, ["a", "c"], "y")
    assert load_model(save_model(model, str(tmp_path), "m", "r")) == model


def test_held_histograms():
    held = HeldCells(np.array([[0, 1], [1, 0], [1, 2]]), np.array([2.0, 1.0, 3.0]), np.array([4.0, 1.0, 9.0]), (2, 3), np.array([2, 2]))
    held.start(1.0)
    tree = boosting.Tree()
    tree.add(0, 0)
    held.begin(tree)
    found = held.histograms(tree, [0])[0]
    assert found[0].tolist() == [[-2.0, 2.0, 2.0], [-6.0, 4.0, 4.0], [0.0, 0.0, 0.0]]
    assert found[1].tolist() == [[0.0, 1.0, 1.0], [-2.0, 2.0, 2.0], [-6.0, 3.0, 3.0]]
