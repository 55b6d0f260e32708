"""Estimators by model kind, with parameters named as users of common ML libraries know them."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.errors import OptionError, TrainingError
from wattline.operators.boosting import EnsembleModel, Growth, fit_boosted, fit_forest
from wattline.operators.class_forest import ClassForest, fit_class_forest, split_features
from wattline.operators.linear import Gram, LinearNet, gram, solve

# Spark's trees are at most this deep.
MAX_DEPTH = 30


@dataclass(frozen=True)
class ModelDefinition:
    name: str
    kind: str
    params: Mapping[str, Any] = field(default_factory=dict)


# The default search space.
DEFAULT_MODELS = (
    ModelDefinition("rf_small", "random_forest_regressor", {"n_estimators": 200, "max_depth": 12}),
    ModelDefinition("gbm", "gradient_boosting", {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 4}),
    ModelDefinition("xgb", "xgboost", {"n_estimators": 400, "max_depth": 8, "learning_rate": 0.05}),
    ModelDefinition("lgbm", "lightgbm", {"num_leaves": 64, "learning_rate": 0.03, "n_estimators": 300}),
    ModelDefinition("elastic_net", "elastic_net", {"alpha": 0.1, "l1_ratio": 0.5}),
)

# Parameters without a counterpart here; accepted so that existing definitions run.
IGNORED = {"n_jobs", "verbose", "verbosity"}
DEFAULT_SEED = 42


def _depth(value: Any, default: int) -> int:
    if value is None or value == "None":
        return default
    if int(value) > MAX_DEPTH:
        raise OptionError(f"trees are at most {MAX_DEPTH} deep, not {value}")
    return int(value)


def _seed(params: Mapping[str, Any]) -> int:
    value = params.get("random_state")
    return DEFAULT_SEED if value is None else int(value)


def _reject_unknown(kind: str, params: Mapping[str, Any], known: set[str]) -> None:
    unknown = set(params) - known - IGNORED
    if unknown:
        raise OptionError(f"{kind}: unknown parameters {sorted(unknown)}")


def _least_leaf(params: Mapping[str, Any]) -> int:
    """Least rows of a leaf. A node that must hold ``min_samples_split`` rows to be split is one whose halves hold half as many."""
    return max(int(params.get("min_samples_leaf", 1)), int(params.get("min_samples_split", 2)) // 2)


_FOREST = {
    "n_estimators", "max_depth", "random_state", "max_features", "max_bins", "min_samples_leaf", "min_samples_split", "bootstrap",
}


def _forest_options(kind: str, params: Mapping[str, Any], features: str) -> dict[str, Any]:
    _reject_unknown(kind, params, _FOREST)
    return {
        "numTrees": int(params.get("n_estimators", 100)),
        "maxDepth": _depth(params.get("max_depth"), MAX_DEPTH),
        "seed": _seed(params),
        "bootstrap": bool(params.get("bootstrap", True)),
        "featureSubsetStrategy": str(params.get("max_features", features)),
        "maxBins": int(params.get("max_bins", 32)),
        "minInstancesPerNode": _least_leaf(params),
    }


def _forest_regressor(params, label_std):
    return RandomForestRegressor(
        featuresCol="features", labelCol="label", **_forest_options("random_forest_regressor", params, "all")
    )


def _forest_classifier(params, label_std):
    return RandomForestClassifier(
        featuresCol="features", labelCol="label", **_forest_options("random_forest_classifier", params, "sqrt")
    )


_BOOSTED = {
    "n_estimators", "learning_rate", "max_depth", "num_leaves", "random_state", "subsample", "max_bins", "min_samples_leaf",
    "min_samples_split",
}


def _boosted(kind: str, depth: int, rate: float):
    def build(params, label_std):
        _reject_unknown(kind, params, _BOOSTED)
        default = depth
        if "num_leaves" in params:
            # Trees here grow by level: the depth that can hold as many leaves.
            default = max(1, math.ceil(math.log2(int(params["num_leaves"]))))
        limit = params.get("max_depth")
        return GBTRegressor(
            featuresCol="features",
            labelCol="label",
            maxIter=int(params.get("n_estimators", 100)),
            stepSize=float(params.get("learning_rate", rate)),
            maxDepth=default if limit in (None, "None", -1) else _depth(limit, default),
            maxBins=int(params.get("max_bins", 32)),
            minInstancesPerNode=_least_leaf(params),
            subsamplingRate=float(params.get("subsample", 1.0)),
            seed=_seed(params),
            checkpointInterval=10,
        )

    return build


def _elastic_net(params, label_std):
    """Objective 1/(2n)|y-Xw|^2 + alpha*l1_ratio*|w|_1 + alpha*(1-l1_ratio)/2*|w|^2.

    Spark fits on the label divided by its standard deviation, which weakens the quadratic
    part by that factor; the factor is put back here. The normal-equation solver divides by the
    population deviation, so it is named instead of being left to a choice.
    """
    _reject_unknown("elastic_net", params, {"alpha", "l1_ratio", "max_iter", "tol", "fit_intercept", "random_state"})
    alpha = float(params.get("alpha", 1.0))
    ratio = float(params.get("l1_ratio", 0.5))
    first = alpha * ratio
    second = alpha * (1.0 - ratio) * (label_std or 1.0)
    total = first + second
    return LinearRegression(
        featuresCol="features",
        labelCol="label",
        standardization=False,
        solver="normal",
        fitIntercept=bool(params.get("fit_intercept", True)),
        maxIter=int(params.get("max_iter", 1000)),
        tol=float(params.get("tol", 1e-9)),
        regParam=total,
        elasticNetParam=first / total if total else 0.0,
    )


BUILDERS: dict[str, Callable[[Mapping[str, Any], float | None], Any]] = {
    "random_forest_regressor": _forest_regressor,
    "random_forest_classifier": _forest_classifier,
    "gradient_boosting": _boosted("gradient_boosting", 3, 0.1),
    "xgboost": _boosted("xgboost", 6, 0.3),
    "lightgbm": _boosted("lightgbm", 5, 0.1),
    "elastic_net": _elastic_net,
}


def build(definition: ModelDefinition, label_std: float | None = None):
    """The unfitted Spark ML estimator."""
    if definition.kind not in BUILDERS:
        raise OptionError(f"unknown model kind {definition.kind!r}; known: {sorted(BUILDERS)}")
    return BUILDERS[definition.kind](definition.params, label_std)


#: Cells times trees up to which a bootstrapped forest is grown from sums per cell.
MOST_BAGGED = 2_000_000


def _chosen_features(value: Any, count: int) -> int | None:
    """Features that a split may use; None is all."""
    if value in (None, "all", "None", 1.0):
        return None
    if value in ("auto", "onethird"):
        return max(1, count // 3)
    if value in ("sqrt", "log2"):
        return max(1, int(math.sqrt(count) if value == "sqrt" else math.log2(count)))
    number = float(value)
    return max(1, int(number * count) if isinstance(value, float) and number <= 1 else int(number))


def _no_limit(value: Any) -> int | None:
    return None if value in (None, "None", -1, 0) else int(value)


def _whole_rows(params: Mapping[str, Any]) -> bool:
    """Sampling of rows needs rows, which cells do not keep; such definitions are fitted by Spark's own estimators."""
    return float(params.get("subsample", 1.0)) == 1.0


_GBM = {
    "n_estimators", "learning_rate", "max_depth", "max_leaf_nodes", "min_samples_leaf", "min_samples_split", "max_features", "max_bins", "subsample", "random_state", "init",
}
_XGB = {
    "n_estimators", "learning_rate", "eta", "max_depth", "max_leaves", "grow_policy", "reg_lambda", "reg_alpha", "gamma", "min_child_weight", "max_bin", "max_bins", "subsample",
    "colsample_bytree", "random_state", "min_samples_leaf", "min_samples_split",
}
_LGBM = {
    "n_estimators", "learning_rate", "num_leaves", "max_depth", "min_child_samples", "min_child_weight", "reg_lambda", "reg_alpha", "min_split_gain", "max_bin", "max_bins",
    "subsample", "colsample_bytree", "random_state",
}


def _gbm_fit(params, train, features, target):
    _reject_unknown("gradient_boosting", params, _GBM)
    growth = Growth(
        max_depth=_depth(params.get("max_depth", 3), MAX_DEPTH), max_leaves=_no_limit(params.get("max_leaf_nodes")), min_rows=float(params.get("min_samples_leaf", 1)),
        min_split_rows=float(params.get("min_samples_split", 2)), features_per_split=_chosen_features(params.get("max_features"), len(features)),
    )
    return fit_boosted(
        train, features, target, growth, int(params.get("n_estimators", 100)), float(params.get("learning_rate", 0.1)), int(params.get("max_bins", 255)),
        seed=_seed(params), init=str(params.get("init") or "mean"),
    )


def _xgb_fit(params, train, features, target):
    """Level-wise trees with a penalty on leaf values; ``gamma`` is compared with half the gain, as that library defines it."""
    _reject_unknown("xgboost", params, _XGB)
    lossguide = params.get("grow_policy", "depthwise") == "lossguide"
    if params.get("max_leaves") and not lossguide:
        raise OptionError("max_leaves needs grow_policy 'lossguide'")
    growth = Growth(
        max_depth=_no_limit(params.get("max_depth", 0 if lossguide else 6)), max_leaves=_no_limit(params.get("max_leaves")), min_rows=float(params.get("min_samples_leaf", 1)),
        min_split_rows=float(params.get("min_samples_split", 2)), min_hessian=float(params.get("min_child_weight", 1.0)), reg_lambda=float(params.get("reg_lambda", 1.0)),
        reg_alpha=float(params.get("reg_alpha", 0.0)), min_gain=2.0 * float(params.get("gamma", 0.0)), features_per_tree=float(params.get("colsample_bytree", 1.0)),
    )
    rate = float(params.get("learning_rate", params.get("eta", 0.3)))
    bins = int(params.get("max_bin", params.get("max_bins", 256)))
    return fit_boosted(train, features, target, growth, int(params.get("n_estimators", 100)), rate, bins, missing_allowed=True, seed=_seed(params))


def _lgbm_fit(params, train, features, target):
    """Leaf-wise trees: best first, up to ``num_leaves`` leaves."""
    _reject_unknown("lightgbm", params, _LGBM)
    growth = Growth(
        max_depth=_no_limit(params.get("max_depth", -1)), max_leaves=int(params.get("num_leaves", 31)), min_rows=float(params.get("min_child_samples", 20)),
        min_hessian=float(params.get("min_child_weight", 1e-3)), reg_lambda=float(params.get("reg_lambda", 0.0)), reg_alpha=float(params.get("reg_alpha", 0.0)),
        min_gain=float(params.get("min_split_gain", 0.0)), features_per_tree=float(params.get("colsample_bytree", 1.0)),
    )
    bins = int(params.get("max_bin", params.get("max_bins", 255)))
    rate = float(params.get("learning_rate", 0.1))
    return fit_boosted(train, features, target, growth, int(params.get("n_estimators", 100)), rate, bins, missing_allowed=True, seed=_seed(params))


def _forest_fit(params, train, features, target):
    _reject_unknown("random_forest_regressor", params, _FOREST)
    growth = Growth(
        max_depth=_depth(params.get("max_depth"), MAX_DEPTH), min_rows=float(params.get("min_samples_leaf", 1)), min_split_rows=float(params.get("min_samples_split", 2)),
        features_per_split=_chosen_features(params.get("max_features"), len(features)),
    )
    return fit_forest(
        train, features, target, growth, int(params.get("n_estimators", 100)), int(params.get("max_bins", 255)), bool(params.get("bootstrap", True)), _seed(params), MOST_BAGGED
    )


def _class_forest_fit(params, train, features, target):
    options = _forest_options("random_forest_classifier", params, "sqrt")
    _check_classes(train, target)
    trees = options["numTrees"]
    growth = Growth(max_depth=options["maxDepth"], min_rows=float(options["minInstancesPerNode"]), features_per_split=split_features(options["featureSubsetStrategy"], len(features), trees))
    return fit_class_forest(train, features, target, growth, trees, options["maxBins"], options["bootstrap"], options["seed"], MOST_BAGGED)


#: Kinds that are fitted on cells: (parameters, table, features, target) to a model, or None if the cells are too many.
CELL_FITS: dict[str, Callable[..., EnsembleModel | ClassForest | None]] = {
    "random_forest_regressor": _forest_fit, "random_forest_classifier": _class_forest_fit, "gradient_boosting": _gbm_fit, "xgboost": _xgb_fit, "lightgbm": _lgbm_fit,
}


def label_deviation(df: DataFrame, target: str, sample: bool = False) -> float:
    """The standard deviation that a solver scales labels by: of the population, or of a sample."""
    return float(df.agg((F.stddev_samp if sample else F.stddev_pop)(target)).first()[0] or 0.0)


def _check_classes(df: DataFrame, target: str) -> None:
    """A continuous target is an error; any number of classes is not."""
    if isinstance(df.schema[target].dataType, T.FractionalType):
        fractional = df.where(F.col(target) != F.floor(F.col(target))).limit(1).count()
        if fractional:
            raise TrainingError(f"{target!r} is continuous; a classifier needs classes")


_NET = {"alpha", "l1_ratio", "max_iter", "tol", "fit_intercept", "random_state"}
#: Models of this library, which keep themselves as text.
OWN_MODELS = {m.FORMAT: m for m in (EnsembleModel, ClassForest, LinearNet)}
Model = PipelineModel | EnsembleModel | ClassForest | LinearNet


def fit_net(params: Mapping[str, Any], sums: Gram) -> LinearNet:
    _reject_unknown("elastic_net", params, _NET)
    return solve(
        sums, float(params.get("alpha", 1.0)), float(params.get("l1_ratio", 0.5)), bool(params.get("fit_intercept", True)),
        int(params.get("max_iter", 1000)), float(params.get("tol", 1e-9)),
    )


def fit(
    definition: ModelDefinition, train: DataFrame, features: Sequence[str], target: str = "total_load", sums: Gram | None = None
) -> Model:
    """A fitted model. It scores a table that holds the feature columns.

    Tree kinds are fitted on cells (see ``cells.py``), elastic nets on a Gram matrix (``sums``, if it is known already). Spark's own estimators
    take tree kinds whose rows are sampled (``subsample`` below 1), bootstrapped forests over more than ``MOST_BAGGED`` cells times trees (for
    classifiers times classes, bootstrapped or not), and nets without intercept.
    """
    if definition.kind in CELL_FITS and _whole_rows(definition.params):
        model = CELL_FITS[definition.kind](definition.params, train, features, target)
        if model is not None:
            return model
    if definition.kind == "elastic_net" and definition.params.get("fit_intercept", True):
        return fit_net(definition.params, sums or gram(train, features, target))
    stages: list[Any] = [VectorAssembler(inputCols=list(features), outputCol="features")]
    if definition.kind == "random_forest_classifier":
        _check_classes(train, target)
        labels = StringIndexer(inputCol=target, outputCol="label").fit(train)
        estimator = build(definition).setPredictionCol("class_index")
        back = IndexToString(inputCol="class_index", outputCol="prediction", labels=labels.labels)
        fitted = Pipeline(stages=[*stages, estimator, back]).fit(labels.transform(train.select(*features, target)))
        return fitted
    prepared = train.select(*features, F.col(target).cast("double").alias("label"))
    deviation = (label_deviation(prepared, "label") or None) if definition.kind == "elastic_net" else None
    return Pipeline(stages=[*stages, build(definition, deviation)]).fit(prepared)


def predict(model: Model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Kept columns and ``prediction``. No shuffle."""
    return model.transform(df).select(*keep, "prediction")


def save_model(model: Model, base: str, name: str, run_id: str) -> str:
    """Write a model; this library's own as one JSON line below ``metadata``, where pipelines keep theirs."""
    path = f"{base.rstrip('/')}/{name}_{run_id}"
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
    else:
        text = json.dumps({"class": model.FORMAT, "model": model.to_json()})
        SparkSession.active().createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
    return path


def load_model(path: str) -> Model:
    try:
        first = SparkSession.active().read.text(f"{path}/metadata", wholetext=True).first()
        told = json.loads(first["value"])
        if told["class"] in OWN_MODELS:
            return OWN_MODELS[told["class"]].from_json(told["model"])
        return PipelineModel.load(path)
    except Exception as error:
        raise TrainingError(f"no model can be loaded from {path!r}") from error
