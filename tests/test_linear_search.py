"""Elastic nets from a Gram matrix, and search strategies."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.errors import OptionError, TrainingError
from wattline.operators import linear
from wattline.operators import search as search_module
from wattline.operators.linear import gram, mean_squared_error, net_path, solve
from wattline.operators.models import ModelDefinition, fit, load_model, save_model
from wattline.operators.search import Halving, best_trial, choose, grid, halving_search, search, survivors

FEATURES = ["a", "b", "c"]


def draw(n=500, seed=1, far=1e6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1.0, 5.0, 0.2] + [far, -3.0, 0.0]
    y = (x - [far, 0, 0]) @ [2.0, -1.0, 4.0] + 7.0 + rng.normal(size=n)
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, y double").repartition(4)


def worst_slope(x, y, model, alpha, ratio):
    """How far the model is from the optimality conditions, coordinate by coordinate."""
    w = np.array(model.coefficients)
    rest = y - x @ w - model.intercept
    assert rest.mean() == pytest.approx(0.0, abs=1e-6)
    pull = (x - x.mean(0)).T @ rest / len(y) - alpha * (1 - ratio) * w
    first = alpha * ratio
    return max(abs(p - math.copysign(first, v)) if v else max(abs(p) - first, 0.0) for p, v in zip(pull, w, strict=True))


@pytest.mark.parametrize("dense", [1024, 1])
@pytest.mark.parametrize("alpha, ratio", [(0.1, 0.5), (3.0, 0.9), (0.5, 0.0), (0.0, 0.5), (1.0, 1.0), (1e5, 0.5)])
def test_optimality(spark, monkeypatch, dense, alpha, ratio):
    monkeypatch.setattr(linear, "DENSE_FEATURES", dense)
    x, y = draw(far=1e6 if dense > 1 else 3.0)
    g = gram(frame(spark, x, y), FEATURES, "y")
    model = solve(g, alpha, ratio)
    assert worst_slope(x, y, model, alpha, ratio) < 1e-5
    assert mean_squared_error(g, model) == pytest.approx(np.mean((y - x @ model.coefficients - model.intercept) ** 2), rel=1e-6)
    assert alpha < 1e5 or model.coefficients == [0.0, 0.0, 0.0]


def test_path_and_other_slice(spark):
    x, y = draw()
    train, held = frame(spark, x[:300], y[:300]), frame(spark, x[300:], y[300:])
    g, h = gram(train, FEATURES, "y"), gram(held, FEATURES, "y")
    alphas = [0.5, 10.0, 0.01, 2.0]
    for alpha, model in zip(alphas, net_path(g, alphas, 0.7), strict=True):
        assert model.coefficients == pytest.approx(solve(g, alpha, 0.7).coefficients, abs=1e-6)
        scored = model.transform(held).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
        # the held slice has a shift of its own
        assert mean_squared_error(h, model) == pytest.approx(scored, rel=1e-6)


def test_sparse_features_beyond_the_dense_bound(spark):
    names = [f"f{k}" for k in range(1100)]
    rng = random.Random(3)
    rows = []
    for _ in range(150):
        row = [0.0] * 1100
        for k in rng.sample(range(1100), 4):
            row[k] = rng.random()
        rows.append((*row, 3.0 * row[0] + 2.0 * row[1] + 1.0))
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in [*names, "y"])).coalesce(2)
    g = gram(df, names, "y")
    assert len(g.values) < 150 * 17 and g.shift.any() == False  # noqa: E712
    x, y = np.array([r[:-1] for r in rows]), np.array([r[-1] for r in rows])
    assert worst_slope(x, y, solve(g, 0.001, 0.5), 0.001, 0.5) < 1e-6


def test_unusable_rows_and_options(spark):
    x, y = draw(20)
    df = frame(spark, x, y)
    for bad in ((None, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, float("nan"))):
        with pytest.raises(TrainingError, match="1 rows"):
            gram(df.union(spark.createDataFrame([bad], df.schema)), FEATURES, "y")
    with pytest.raises(TrainingError, match="no rows"):
        gram(df.limit(0), FEATURES, "y")
    for params in ({"alpha": -1.0}, {"l1_ratio": 2.0}, {"beta": 1}):
        with pytest.raises(OptionError):
            fit(ModelDefinition("m", "elastic_net", params), df, FEATURES, "y")
    constant = solve(gram(df.withColumn("a", F.lit(4.0)), FEATURES, "y"), 0.0, 0.5)
    assert constant.coefficients[0] == 0.0 and constant.coefficients[1] != 0.0


def test_saved_net(spark, tmp_path):
    x, y = draw()
    model = fit(ModelDefinition("m", "elastic_net", {}), frame(spark, x, y), FEATURES, "y")
    assert load_model(save_model(model, str(tmp_path), "m", "r")) == model


def test_choose():
    defs = [ModelDefinition(str(k), "elastic_net") for k in range(10)]
    assert choose(defs) == defs and choose(defs, "grid", 3) == defs[:3] and choose(defs, "halving", 99) == defs
    drawn = choose(defs, "random", 4)
    assert len(drawn) == 4 and drawn == choose(defs, "random", 4) and drawn != defs[:4] and drawn == sorted(drawn, key=lambda d: int(d.name))
    for bad in (("bayes", 3), ("grid", 0)):
        with pytest.raises(OptionError):
            choose(defs, *bad)


def test_rungs():
    assert Halving(90, 3).rungs(9) == [(9, 3), (3, 10), (1, 30)]
    for n in range(1, 40):
        for eta in (2, 3, 5):
            rungs = Halving(1000, eta).rungs(n)
            assert sum(a * b for a, b in rungs) <= 1000 and rungs[0][0] == n and rungs[-1][0] == 1
    with pytest.raises(OptionError):
        Halving(5).rungs(9)
    assert survivors({0: 3.0, 1: 1.0, 2: 1.0, 3: math.nan, 4: math.inf}, 2) == [1, 2]


@pytest.fixture(scope="module")
def slices(spark):
    rng = random.Random(5)
    rows = [(h, d, int(d > 4), 10.0 * h + 40.0 * (d > 4) * (h > 12) + rng.random()) for h in range(24) for d in range(7) for _ in range(6)]
    df = spark.createDataFrame(rows, "a long, b long, c long, y double").repartition(3)
    return df.sample(0.6, 1).persist(), df.sample(0.6, 2).persist()


def contenders():
    return [
        *grid("gbm", "gradient_boosting", {"learning_rate": [0.01, 0.3], "max_depth": [1, 4]}, {"n_estimators": 60}),
        *grid("lgbm", "lightgbm", {"num_leaves": [2, 31], "learning_rate": [0.1]}, {"n_estimators": 8}),
        ModelDefinition("net", "elastic_net", {"alpha": 0.1}), ModelDefinition("bad", "elastic_net", {"alpha": -1.0}),
    ]


def test_halving_equals_a_restatement_and_goes_on_after_a_stop(spark, slices, tmp_path, monkeypatch):
    train, held = slices
    definitions, halving = contenders(), Halving(120, 2)
    # by hand: fit every rung's trials apart
    going, spent = list(range(len(definitions))), 0
    label = held.withColumn("label", F.col("y"))
    for n, most in halving.rungs(len(definitions)):
        scores = {}
        if len(going) > n:
            going = [k for _, k in sorted((last[k], k) for k in going if k in last)[:n]]
            going.sort()
        for k in going:
            d = definitions[k]
            rounds = 1 if d.kind == "elastic_net" else min(most, d.params["n_estimators"])
            spent += rounds
            params = d.params if d.kind == "elastic_net" else {**d.params, "n_estimators": rounds}
            try:
                model = fit(ModelDefinition(d.name, d.kind, params), train, FEATURES, "y")
            except OptionError:
                continue
            scores[k] = model.transform(label).agg(F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2))).first()[0]
        last = scores
    assert spent <= 120
    fits = []
    plain = search_module.fit
    monkeypatch.setattr(search_module, "fit", lambda d, *rest: fits.append(d) or plain(d, *rest))
    trials = search(train, held, FEATURES, "y", definitions, strategy="halving", halving=halving, models_path=f"{tmp_path}/m", trials_path=f"{tmp_path}/t")
    assert sum(d.params.get("n_estimators", 1) for d in fits) <= 120
    best = best_trial(trials)
    assert [t.ordinal for t in trials if t.status == "success"] == going == [best.ordinal] and best.metrics["rmse"] == pytest.approx(last[going[0]])
    assert {t.status for t in trials} == {"success", "stopped", "failed"} and [t.ordinal for t in trials] == list(range(len(definitions)))
    table = spark.read.parquet(f"{tmp_path}/t")
    assert [r["count"] for r in table.groupBy("rung").count().orderBy("rung").collect()] == [n if n > 1 else 1 for n, _ in halving.rungs(len(definitions))]
    # a search that ended behind its second rung goes on with the third
    table.where("rung < 2").write.parquet(f"{tmp_path}/stopped")
    fits.clear()
    again = search(train, held, FEATURES, "y", definitions, strategy="halving", halving=halving, models_path=f"{tmp_path}/m", trials_path=f"{tmp_path}/stopped")
    assert 0 < len(fits) < len(definitions) // 2
    assert [(t.ordinal, t.status, t.metrics) for t in again] == [(t.ordinal, t.status, t.metrics) for t in trials]
    # and a finished one fits nothing, but has its model
    fits.clear()
    whole = search(train, held, FEATURES, "y", definitions, strategy="halving", halving=halving, models_path=f"{tmp_path}/m", trials_path=f"{tmp_path}/t")
    assert not fits and best_trial(whole).model == best.model
    # other definitions are another search
    halving_search(train, held, FEATURES, "y", definitions[:2], Halving(20, 2), models_path=f"{tmp_path}/m", trials_path=f"{tmp_path}/t")
    assert fits
    with pytest.raises(OptionError):
        halving_search(train, held, FEATURES, "y", definitions, halving, trials_path=f"{tmp_path}/t")


def test_one_gram_matrix_for_all_nets(slices, monkeypatch):
    train, held = slices
    made = []
    plain = search_module.gram
    monkeypatch.setattr(search_module, "gram", lambda *given: made.append(1) or plain(*given))
    trials = search(train, held, FEATURES, "y", grid("net", "elastic_net", {"alpha": [0.1, 1.0, 10.0], "l1_ratio": [0.1, 0.9]}))
    assert len(made) == 1 and all(t.status == "success" for t in trials)
    assert len(search(train, held, FEATURES, "y", contenders(), max_trials=3)) == 3
