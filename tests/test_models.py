import math
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from helpers import at
from wattline.errors import OptionError, TrainingError
from wattline.operators.models import DEFAULT_MODELS, ModelDefinition, build, fit, load_model, predict, save_model
from wattline.operators.search import best_trial, grid, search, trial_table

FEATURES = ["hour_of_day", "is_weekend"]


@pytest.fixture(scope="module")
def table(spark):
    draw = random.Random(2)
    data = [(at(i), i // 4 % 24, int(i // 96 % 7 > 4), 10.0 * (i // 4 % 24) + 50.0 * (i // 96 % 7 > 4) + draw.random()) for i in range(1400)]
    df = spark.createDataFrame(data, "timestamp timestamp_ntz, hour_of_day bigint, is_weekend bigint, total_load double")
    return df.persist()


def error(model, df):
    scored = model.transform(df)
    return scored.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("total_load"), 2)))).first()[0]


@pytest.mark.parametrize(
    "kind, params",
    [
        ("random_forest_regressor", {"n_estimators": 5, "max_depth": 6, "random_state": 1, "n_jobs": -1}),
        ("gradient_boosting", {"n_estimators": 5, "learning_rate": 0.5, "max_depth": 4}),
        ("xgboost", {"n_estimators": 5, "learning_rate": 0.5, "max_depth": 4, "subsample": 0.8}),
        ("lightgbm", {"n_estimators": 5, "learning_rate": 0.5, "num_leaves": 16}),
        ("elastic_net", {"alpha": 0.1}),
    ],
)
def test_every_kind_beats_the_mean(table, kind, params):
    model = fit(ModelDefinition("m", kind, params), table, FEATURES)
    spread = table.agg(F.stddev_pop("total_load")).first()[0]
    assert error(model, table) < 0.5 * spread


@pytest.mark.parametrize("alpha, ratio", [(0.1, 0.5), (50.0, 0.9), (5.0, 0.0), (0.0, 0.5), (1e6, 1.0)])
def test_elastic_net_equals_the_closed_form(table, alpha, ratio):
    s = table.agg(F.covar_pop("hour_of_day", "total_load"), F.var_pop("hour_of_day"), F.avg("hour_of_day"), F.avg("total_load")).first()
    slope = math.copysign(max(abs(s[0]) - alpha * ratio, 0.0), s[0]) / (s[1] + alpha * (1 - ratio))
    model = fit(ModelDefinition("m", "elastic_net", {"alpha": alpha, "l1_ratio": ratio}), table, ["hour_of_day"])
    assert model.stages[-1].coefficients[0] == pytest.approx(slope, rel=1e-5, abs=1e-5)
    assert model.stages[-1].intercept == pytest.approx(s[3] - slope * s[2], rel=1e-5)


def test_constant_target(spark):
    df = spark.createDataFrame([(i, 5.0) for i in range(10)], "x int, total_load double")
    model = fit(ModelDefinition("m", "elastic_net", {"alpha": 0.1}), df, ["x"])
    assert error(model, df) == pytest.approx(0.0, abs=1e-9)


def test_parameters_translate():
    forest = build(ModelDefinition("f", "random_forest_regressor", {"n_estimators": 7, "max_depth": "None"}))
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getFeatureSubsetStrategy()) == (7, 30, "all")
    assert build(ModelDefinition("l", "lightgbm", {"num_leaves": 64})).getMaxDepth() == 6
    assert build(ModelDefinition("l", "lightgbm", {"num_leaves": 64, "max_depth": -1})).getMaxDepth() == 6
    assert build(DEFAULT_MODELS[2]).getMaxIter() == 400
    with pytest.raises(OptionError):
        build(ModelDefinition("x", "svm"))
    with pytest.raises(OptionError):
        build(ModelDefinition("x", "xgboost", {"depth": 3}))


def test_classifier_returns_classes_and_refuses_a_continuous_target(spark, table):
    classes = table.withColumn("kind", F.when(F.col("hour_of_day") < 12, "am").otherwise("pm"))
    definition = ModelDefinition("c", "random_forest_classifier", {"n_estimators": 3, "max_depth": 4})
    model = fit(definition, classes, FEATURES, "kind")
    assert predict(model, classes, ["kind"]).where("kind <> prediction").isEmpty()
    with pytest.raises(TrainingError):
        fit(definition, table, FEATURES)


def test_classifier_is_grown_from_cells(spark, monkeypatch, tmp_path):
    """However many rows, training sees one number per cell, class and tree; beyond a bound Spark's own forest takes over."""
    rows = spark.range(9000).select(
        (F.col("id") % 24).alias("hour_of_day"), (F.col("id") % 7).alias("day_of_week"), F.when(F.col("id") % 24 < 8, "night").when(F.col("id") % 7 < 5, "work").otherwise("home").alias("kind")
    )
    definition = ModelDefinition("c", "random_forest_classifier", {"n_estimators": 20, "max_depth": 12})
    features = ["hour_of_day", "day_of_week"]
    model = fit(definition, rows, features, "kind")
    assert not isinstance(model, PipelineModel)
    assert sum(model.trees[0].rows[k] for k in range(len(model.trees[0].rows)) if model.trees[0].feature[k] < 0) == pytest.approx(9000, rel=0.1)
    assert predict(model, rows, ["kind"]).where("kind <> prediction").isEmpty()
    loaded = load_model(save_model(model, str(tmp_path), "c", "run1"))
    assert predict(loaded, rows, ["kind"]).where("kind <> prediction").isEmpty()
    assert fit(definition, rows, features, "kind").to_json() == model.to_json()
    for broken in (rows.withColumn("kind", F.lit(None).cast("string")), rows.withColumn("day_of_week", F.lit(None).cast("int")), rows.limit(0)):
        with pytest.raises(TrainingError):
            fit(definition, broken, features, "kind")
    monkeypatch.setattr("wattline.operators.models.MOST_BAGGED", 100)
    assert isinstance(fit(definition, rows.limit(500), features, "kind"), PipelineModel)


def test_save_and_load(table, tmp_path):
    model = fit(ModelDefinition("m", "random_forest_regressor", {"n_estimators": 3, "max_depth": 3}), table, FEATURES)
    loaded = load_model(save_model(model, str(tmp_path), "m", "run1"))
    before, after = (sorted(map(str, predict(m, table, ["timestamp"]).collect())) for m in (model, loaded))
    assert before == after
    with pytest.raises(TrainingError):
        load_model(f"{tmp_path}/none")


def test_grid():
    made = grid("rf", "random_forest_regressor", {"n_estimators": [50, 100, 200], "max_depth": [None, 10, 20], "max_bins": [2, 5]}, {"random_state": 42})
    assert len(made) == 18 and made[1].params == {"random_state": 42, "n_estimators": 50, "max_depth": None, "max_bins": 5}
    assert len(grid("rf", "random_forest_regressor", {"n_estimators": [1, 2]}, max_trials=1)) == 1


def test_search_records_failures_and_picks_the_best(spark, table):
    definitions = [
        ModelDefinition("bad", "elastic_net", {"alpha": -1.0}),
        ModelDefinition("flat", "elastic_net", {"alpha": 1e9}),
        ModelDefinition("net", "elastic_net", {"alpha": 0.1}),
        ModelDefinition("same", "elastic_net", {"alpha": 0.1}),
    ]
    trials = search(table, table, FEATURES, definitions=definitions)
    assert [t.status for t in trials] == ["failed", "success", "success", "success"]
    assert trials[0].metrics == {} and trials[0].error_message
    assert best_trial(trials).definition.name == "net"
    assert trial_table(spark, trials).where("status = 'success'").count() == 3
    with pytest.raises(TrainingError):
        best_trial(trials[:1])
    with pytest.raises(TrainingError):
        search(table, table, FEATURES, definitions=definitions[:1], fail_fast=True)
    with pytest.raises(TrainingError):
        search(table, table.limit(0), FEATURES, definitions=definitions[2:3], fail_fast=True)
