"""Training, search, evaluation, registry, scoring, drift and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.errors import TrainingError
from wattline.operators.drift import (
    DRIFT_RATIOS,
    detect_drift,
    drift_ratios as above_ratio,
    latest_report as newest_report,
    retrain_decision as decide,
)
from wattline.operators.evaluate import (
    evaluate,
    metric_violations as unsound_metrics,
    metrics_long,
    threshold_breaches as breaches,
)
from wattline.operators.models import DEFAULT_MODELS, ModelDefinition, fit, load_model, predict, save_model
from wattline.operators.search import Halving, Trial, grid, search, trial_table
from wattline.operators.select import champion_vs_baseline as champion_or_baseline
from wattline.operators.select import select_best as best_of
from wattline.operators.select import select_best_lenient as best_of_lenient
from wattline.operators.split import split_frames
from wattline.plans.compare import candidate, compare_models as compare, promote_from_results
from wattline.plans.monitor import MonitorOptions, monitor_job
from wattline.plans.prepare import PrepareOptions
from wattline.plans.score import score_job
from wattline.plans.train import TrainOptions, log_trials, train_job
from wattline.sources.tables import (
    COMPARISON_SCHEMA,
    REPORT_SCHEMA,
    RUN_PHASES_SCHEMA,
    TRIAL_METRICS_SCHEMA,
    champion,
    load_champion,
    phase_durations,
    read_table,
    register,
    registry_records,
)
from wattline.storage import materialize, scratch_path
from wattline.streaming.fill import StreamFill
from wattline.streaming.live import live_metrics, run_available, score_stream
from wattline.streaming.metrics import LiveMetrics
from wattline.streaming.restate import RestatedFill
from workload import fixtures as fx
from workload.registry import query
from workload.table_queries import raw_file, reading_files
from wattline.operators.contracts import RAW, Contract
from wattline.sources.delimited import scan_delimited as scan_file

FEATURES = ["hour_of_day", "day_of_week", "is_weekend"]
NET = ModelDefinition("elastic_net", "elastic_net", {"alpha": 0.1, "l1_ratio": 0.5})
_TRAIN = f"timestamp <= TIMESTAMP '{fx.TRAIN_END}'"
_VALIDATION = f"timestamp > TIMESTAMP '{fx.TRAIN_END}' AND timestamp <= TIMESTAMP '{fx.VAL_END}'"


def _slices(spark, sf_dir):
    table = materialize(fx.engineered(spark, sf_dir), "engineered")
    return split_frames(table, fx.TRAIN_END, fx.VAL_END)


# --- training --------------------------------------------------------------------------------


def _trained(spark, sf_dir, definition: ModelDefinition):
    """Error on train and validation next to the error of the plain train mean."""
    train, validation, _ = _slices(spark, sf_dir)
    model = fit(definition, train, FEATURES)
    mean = F.lit(train.agg(F.avg("total_load")).first()[0])
    both = train.withColumn("split", F.lit("train")).unionByName(validation.withColumn("split", F.lit("validation")))
    scored = model.transform(both.withColumn("label", F.col("total_load")))
    errors = evaluate(scored, ["split"])
    floor = evaluate(both.select("split", F.col("total_load").alias("label"), mean.alias("prediction")), ["split"], ["rmse"])
    return errors.join(F.broadcast(floor.select("split", F.col("rmse").alias("mean_rmse"))), "split").select(
        F.lit(definition.name).alias("model_name"), "split", "n_rows", "rmse", "mse", "mean_rmse"
    )


@query()
def train_rf(spark, sf_dir):
    return _trained(spark, sf_dir, ModelDefinition("rf", "random_forest_regressor", {"n_estimators": 200, "max_depth": 12}))


_CELLS_SQL = f"""WITH {fx.ENGINEERED_SQL} SELECT hour_of_day, day_of_week, is_weekend, count(*) AS n_rows, round(avg(total_load), 6) AS prediction
    FROM engineered WHERE {_TRAIN} GROUP BY ALL"""


def _cells(spark, sf_dir, definition: ModelDefinition):
    """What a model predicts for each calendar cell of the training slice."""
    train, _, _ = _slices(spark, sf_dir)
    cells = train.groupBy(*FEATURES).agg(F.count(F.lit(1)).alias("n_rows"))
    return predict(fit(definition, train, FEATURES), cells, [*FEATURES, "n_rows"]).withColumn("prediction", F.round("prediction", 6))


@query(_CELLS_SQL)
def train_rf_cells(spark, sf_dir):
    """Whole samples and full depth: every tree, and so the forest, predicts the mean of each cell."""
    params = {"n_estimators": 200, "max_depth": 30, "bootstrap": False}
    return _cells(spark, sf_dir, ModelDefinition("rf", "random_forest_regressor", params))


@query(_CELLS_SQL)
def train_gbt_cells(spark, sf_dir):
    """A first tree of full depth predicts the mean of each cell, and the trees behind it have nothing left to fit."""
    params = {"n_estimators": 3, "learning_rate": 0.05, "max_depth": 30, "init": "tree"}
    return _cells(spark, sf_dir, ModelDefinition("gbm", "gradient_boosting", params))


_BY_NAME = {d.name: d for d in DEFAULT_MODELS}


@query()
def train_gbt(spark, sf_dir):
    return _trained(spark, sf_dir, _BY_NAME["gbm"])


@query()
def train_xgb_like(spark, sf_dir):
    return _trained(spark, sf_dir, _BY_NAME["xgb"])


@query()
def train_lgbm_like(spark, sf_dir):
    return _trained(spark, sf_dir, _BY_NAME["lgbm"])


#: Trees that part all cells: each round takes the same share of what is left of a cell's mean.
_PARTING = {
    "gbm": ModelDefinition("gbm", "gradient_boosting", {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 30}),
    "xgb": ModelDefinition("xgb", "xgboost", {"n_estimators": 400, "learning_rate": 0.05, "max_depth": 0, "reg_lambda": 0.0}),
    "lgbm": ModelDefinition("lgbm", "lightgbm", {"n_estimators": 300, "learning_rate": 0.03, "num_leaves": 512, "min_child_samples": 1}),
}
_SHARES = ", ".join(f"('{n}', 1 - pow(1 - {d.params['learning_rate']}::DOUBLE, {d.params['n_estimators']}))" for n, d in _PARTING.items())


@query(
    f"""WITH {fx.ENGINEERED_SQL}, train AS (SELECT * FROM engineered WHERE {_TRAIN}), whole AS (SELECT avg(total_load) AS mean FROM train),
    cells AS (SELECT hour_of_day, day_of_week, is_weekend, avg(total_load) AS cell_mean FROM train GROUP BY ALL)
    SELECT kind, hour_of_day, day_of_week, is_weekend, round(mean + (cell_mean - mean) * share, 4) AS prediction
    FROM cells, whole, (VALUES {_SHARES}) s(kind, share)"""
)
def boosted_cells(spark, sf_dir):
    """All three boosted kinds with their declared rounds and rates, where every cell has a leaf of its own."""
    train, _, _ = _slices(spark, sf_dir)
    cells = train.select(*FEATURES).distinct()
    guesses = F.array(*[F.struct(F.lit(n).alias("kind"), fit(d, train, FEATURES).column().alias("p")) for n, d in _PARTING.items()])
    return cells.select(*FEATURES, F.inline(guesses)).select("kind", *FEATURES, F.round("p", 4).alias("prediction"))


_STUMPS = {
    "gbm": (ModelDefinition("gbm", "gradient_boosting", {"n_estimators": 1, "learning_rate": 1.0, "max_depth": 1}), 0.0, 1, False),
    "xgb": (ModelDefinition("xgb", "xgboost", {"n_estimators": 1, "learning_rate": 1.0, "max_depth": 1, "reg_lambda": 5.0, "min_child_weight": 8}), 5.0, 8, True),
    "lgbm": (ModelDefinition("lgbm", "lightgbm", {"n_estimators": 1, "learning_rate": 1.0, "num_leaves": 2, "min_child_samples": 20}), 0.0, 20, True),
}
_STUMPS_SQL = ", ".join(f"('{n}', {lam}::DOUBLE, {least}, {str(gaps).lower()})" for n, (_, lam, least, gaps) in _STUMPS.items())


@query(
    f"""WITH {fx.ENGINEERED_SQL}, train AS (SELECT *, minute(timestamp) = 45 AS gap FROM engineered WHERE {_TRAIN}), whole AS (SELECT avg(total_load) AS mean FROM train),
    kinds(kind, lam, least, gaps) AS (VALUES {_STUMPS_SQL}),
    long AS (
      SELECT kind, lam, least, mean - total_load AS g, unnest([
        {{'f': 0, 'x': CASE WHEN NOT (gaps AND gap) THEN hour_of_day END}}, {{'f': 1, 'x': day_of_week}}, {{'f': 2, 'x': is_weekend}}], recursive := true)
      FROM train, whole, kinds
    ), bins AS (SELECT kind, lam, least, f, x, sum(g) AS g, count(*)::DOUBLE AS h FROM long GROUP BY ALL
    ), sums AS (
      SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, lead(x) OVER (PARTITION BY kind, f ORDER BY x NULLS LAST) AS up,
        sum(g) OVER a AS ga, sum(h) OVER a AS ha, coalesce(sum(g) FILTER (x IS NULL) OVER a, 0) AS g0, coalesce(sum(h) FILTER (x IS NULL) OVER a, 0) AS h0
      FROM bins WINDOW w AS (PARTITION BY kind, f ORDER BY x NULLS LAST), a AS (PARTITION BY kind, f)
    ), sides AS (
      SELECT kind, lam, least, f, x, up, ga, ha, gl, hl, CASE WHEN h0 > 0 THEN false ELSE hl * 2 > ha END AS missing_left FROM sums WHERE x IS NOT NULL
      UNION ALL SELECT kind, lam, least, f, x, up, ga, ha, gl + g0, hl + h0, true FROM sums WHERE x IS NOT NULL AND h0 > 0
    ), gains AS (
      SELECT *, gl * gl / (hl + lam) + (ga - gl) * (ga - gl) / (ha - hl + lam) - ga * ga / (ha + lam) AS gain FROM sides WHERE hl >= least AND ha - hl >= least
    ), best AS (SELECT * FROM gains QUALIFY row_number() OVER (PARTITION BY kind ORDER BY gain DESC, f, x, missing_left) = 1)
    SELECT kind, f AS feature, (x + up) / 2.0::DOUBLE AS cut, missing_left, hl AS n_left, ha - hl AS n_right,
      round(-gl / (hl + lam), 4) AS value_left, round(-(ga - gl) / (ha - hl + lam), 4) AS value_right FROM best"""
)
def boosted_first_split(spark, sf_dir):
    """The first split of each boosted kind against all splits there are; the hour is missing on every fourth slot for the kinds that learn a side for that."""
    train, _, _ = _slices(spark, sf_dir)
    gap = F.when(F.minute("timestamp") != 45, F.col("hour_of_day"))
    rows = []
    for name, (definition, _, _, gaps) in _STUMPS.items():
        model = fit(definition, train.withColumn("hour_of_day", gap) if gaps else train, FEATURES)
        tree = model.trees[0]
        cuts = model.binning.cuts[tree.feature[0]]
        cut = cuts[tree.cut[0]] if tree.cut[0] < len(cuts) else None
        sides = tree.left[0], tree.right[0]
        rows.append((name, tree.feature[0], cut, tree.missing_left[0], *(tree.rows[k] for k in sides), *(tree.value[k] for k in sides)))
    found = spark.createDataFrame(rows, "kind string, feature int, cut double, missing_left boolean, n_left double, n_right double, l double, r double")
    return found.select(*found.columns[:6], F.round("l", 4).alias("value_left"), F.round("r", 4).alias("value_right"))


@query()
def train_rf_classifier(spark, sf_dir):
    """The event type from calendar features: share of right guesses per type."""
    rows = fx.events(spark, sf_dir).select("event_type", F.hour("ts").alias("hour_of_day"), F.weekday("ts").alias("day_of_week"))
    rows = materialize(rows, "classes")
    definition = ModelDefinition("rf_class", "random_forest_classifier", {"n_estimators": 100, "max_depth": 12})
    model = fit(definition, rows, ["hour_of_day", "day_of_week"], "event_type")
    right = (F.col("prediction") == F.col("event_type")).cast("double")
    return predict(model, rows, ["event_type"]).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(right).alias("recall")
    )


@query(
    """WITH c AS (SELECT hour(ts)::BIGINT AS hour_of_day, (isodow(ts) - 1)::BIGINT AS day_of_week, event_type, count(*) AS n FROM events GROUP BY ALL)
    SELECT hour_of_day, day_of_week, sum(n)::BIGINT AS n_rows, max(n) AS n_predicted FROM c GROUP BY ALL"""
)
def train_rf_classifier_cells(spark, sf_dir):
    """Whole samples, all features and full depth: a cell's class is one that no other outnumbers."""
    rows = fx.events(spark, sf_dir).select("event_type", F.hour("ts").cast("bigint").alias("hour_of_day"), F.weekday("ts").cast("bigint").alias("day_of_week"))
    rows = materialize(rows, "classes")
    params = {"n_estimators": 3, "max_depth": 30, "bootstrap": False, "max_features": "all"}
    model = fit(ModelDefinition("rf_class", "random_forest_classifier", params), rows, ["hour_of_day", "day_of_week"], "event_type")
    guessed = predict(model, rows, ["event_type", "hour_of_day", "day_of_week"])
    return guessed.groupBy("hour_of_day", "day_of_week").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("prediction") == F.col("event_type")).alias("n_predicted"))


_NET_SQL = f"{fx.ENGINEERED_SQL}, train AS (SELECT * FROM engineered WHERE {_TRAIN}), {fx.elastic_net_sql('train')}"


@query(
    f"""WITH {_NET_SQL} SELECT DISTINCT hour_of_day, round(b + w * hour_of_day, 3) AS prediction FROM engineered, net
    WHERE {_VALIDATION}"""
)
def train_elastic_net(spark, sf_dir):
    train, validation, _ = _slices(spark, sf_dir)
    model = fit(NET, train, ["hour_of_day"])
    return predict(model, validation.select("hour_of_day").distinct(), ["hour_of_day"]).select(
        "hour_of_day", F.round("prediction", 3).alias("prediction")
    )


#: With no first-order penalty three features have a closed form: the ridge equations, solved by determinants.
RIDGE = ModelDefinition("ridge", "elastic_net", {"alpha": 10.0, "l1_ratio": 0.0})


def _ridge_sql(source: str) -> str:
    x = ("hour_of_day", "day_of_week", "is_weekend")
    sums = ", ".join(f"covar_pop({a}, {b}) + {10.0 if a == b else 0.0} AS m{i}{j}" for i, a in enumerate(x) for j, b in enumerate(x))
    right = ", ".join(f"covar_pop({a}, total_load) AS r{i}, avg({a}) AS x{i}" for i, a in enumerate(x))

    def det(column: int | None) -> str:
        m = [[f"r{i}" if j == column else f"m{i}{j}" for j in range(3)] for i in range(3)]
        return " + ".join(f"{m[0][a]} * ({m[1][b]} * {m[2][c]} - {m[1][c]} * {m[2][b]})" for a, b, c in ((0, 1, 2), (1, 2, 0), (2, 0, 1)))

    return f"""stats AS (SELECT {sums}, {right}, avg(total_load) AS my FROM {source}),
    net AS (SELECT *, my - w0 * x0 - w1 * x1 - w2 * x2 AS b FROM (SELECT *, {', '.join(f'({det(k)}) / ({det(None)}) AS w{k}' for k in range(3))} FROM stats))"""


_RIDGE_GUESS = "b + w0 * hour_of_day + w1 * day_of_week + w2 * is_weekend"


@query(
    f"""WITH {fx.ENGINEERED_SQL}, train AS (SELECT * FROM engineered WHERE {_TRAIN}), {_ridge_sql('train')}
    SELECT DISTINCT hour_of_day, day_of_week, is_weekend, round({_RIDGE_GUESS}, 4) AS prediction FROM engineered, net WHERE {_VALIDATION}"""
)
def train_ridge(spark, sf_dir):
    """All three features, from one Gram matrix."""
    train, validation, _ = _slices(spark, sf_dir)
    guesses = predict(fit(RIDGE, train, FEATURES), validation.select(*FEATURES).distinct(), FEATURES)
    return guesses.withColumn("prediction", F.round("prediction", 4))


_GRID = {"alpha": [0.1, 10.0, 50.0], "l1_ratio": [0.1, 0.5, 0.9]}
_GRID_SQL = f"""WITH {fx.ENGINEERED_SQL},
points AS (SELECT unnest([{', '.join(f"{{'i': {i * 3 + j}, 'a': CAST({a} AS DOUBLE), 'r': CAST({r} AS DOUBLE)}}" for i, a in enumerate(_GRID['alpha']) for j, r in enumerate(_GRID['l1_ratio']))}]) AS p),
stats AS (SELECT covar_pop(total_load, hour_of_day) AS c, var_pop(hour_of_day) AS v, avg(total_load) AS my,
  avg(hour_of_day) AS mx FROM engineered WHERE {_TRAIN}),
nets AS (SELECT p.i, p.a, p.r, sign(c) * greatest(abs(c) - p.a * p.r, 0) / (v + p.a * (1 - p.r)) AS w, my - w * mx AS b FROM points, stats)
SELECT 'net_' || i AS model_name, round(sqrt(avg((total_load - (b + w * hour_of_day)) ^ 2)), 3) AS rmse
FROM nets, (SELECT * FROM engineered WHERE {_VALIDATION}) GROUP BY 1"""


@query(_GRID_SQL)
def grid_search(spark, sf_dir):
    train, validation, _ = _slices(spark, sf_dir)
    trials = search(train, validation, ["hour_of_day"], definitions=grid("net", "elastic_net", _GRID), parallelism=8)
    return trial_table(spark, trials).select("model_name", F.round(F.col("metrics")["rmse"], 3).alias("rmse"))


# fails, and is recorded as failed
_BROKEN = ModelDefinition("broken", "elastic_net", {"alpha": -1.0})
#: The declared grid of the forest.
_FOREST_GRID = {"n_estimators": [50, 100, 200], "max_depth": [None, 10, 20], "min_samples_split": [2, 5]}


def _shown(spark, trials):
    return trial_table(spark, trials).select("ordinal", "model_name", "model_kind", "status", F.col("metrics")["rmse"].alias("rmse"))


@query()
def model_search(spark, sf_dir):
    """The default definitions with all their rounds and features, and one that fails."""
    train, validation, _ = _slices(spark, sf_dir)
    return _shown(spark, search(train, validation, FEATURES, definitions=[*DEFAULT_MODELS, _BROKEN]))


@query()
def forest_grid(spark, sf_dir):
    train, validation, _ = _slices(spark, sf_dir)
    definitions = grid("rf", "random_forest_regressor", _FOREST_GRID, {"random_state": 42, "n_jobs": -1}, max_trials=20)
    return _shown(spark, search(train, validation, FEATURES, definitions=definitions))


@query()
def halving_search(spark, sf_dir):
    """A grid of boosted trees and nets under a budget of rounds, and again from the table of rungs that the first search left."""
    train, validation, _ = _slices(spark, sf_dir)
    definitions = [
        *grid("gbm", "gradient_boosting", {"learning_rate": [0.02, 0.1], "max_depth": [2, 4]}, {"n_estimators": 300}),
        *grid("lgbm", "lightgbm", {"num_leaves": [8, 64], "learning_rate": [0.03, 0.3]}, {"n_estimators": 300}), NET, _BROKEN,
    ]
    base = scratch_path(spark, "halving")
    given = {"definitions": definitions, "strategy": "halving", "halving": Halving(600), "models_path": f"{base}/models", "trials_path": f"{base}/rungs"}
    first = search(train, validation, FEATURES, **given)
    again = search(train, validation, FEATURES, **given)
    same = F.lit([(t.run_id, t.status) for t in first] == [(t.run_id, t.status) for t in again])
    return _shown(spark, again).withColumn("resumed", same)


@query()
def compare_models(spark, sf_dir):
    train, validation, _ = _slices(spark, sf_dir)
    base = scratch_path(spark, "compare")
    compare(
        train, validation, FEATURES, DEFAULT_MODELS[0], DEFAULT_MODELS[1:],
        reports=f"{base}/comparisons", registry=f"{base}/registry",
    )
    report = read_table(spark, f"{base}/comparisons", COMPARISON_SCHEMA)
    return report.select("model_id", "role", "is_champion", F.col("metrics")["rmse"].alias("rmse"))


@query(
    f"WITH {fx.ENGINEERED_SQL} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS mismatches FROM engineered WHERE timestamp > TIMESTAMP '{fx.VAL_END}'"
)
def model_roundtrip(spark, sf_dir):
    """A saved and loaded model predicts what it did before."""
    train, _, test = _slices(spark, sf_dir)
    model = fit(DEFAULT_MODELS[0], train, FEATURES)
    loaded = load_model(save_model(model, scratch_path(spark, "models"), "rf", "run"))
    twice = predict(model, test, [*FEATURES, "timestamp"]).withColumnRenamed("prediction", "first")
    again = predict(loaded, twice, ["first"])
    return again.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("first") != F.col("prediction")).alias("mismatches")
    )


# --- evaluation and selection -----------------------------------------------------------------


@query(
    f"""WITH {fx.PREDICTIONS_SQL} SELECT model_name, split, count(*) AS n_rows, round(sqrt(avg((label - prediction) ^ 2)), 4) AS rmse,
    round(avg((label - prediction) ^ 2), 3) AS mse FROM predictions GROUP BY ALL"""
)
def eval_metrics(spark, sf_dir):
    scored = evaluate(fx.predictions(spark, sf_dir), ["model_name", "split"])
    return scored.select("model_name", "split", "n_rows", F.round("rmse", 4).alias("rmse"), F.round("mse", 3).alias("mse"))


_LIMITS = {"rmse": 60.0, "mse": 3500.0}
_LONG_METRICS = "SELECT model_id, half, 'rmse' AS metric, rmse AS value FROM user_metrics UNION ALL SELECT model_id, half, 'mse', mse FROM user_metrics"


@query(
    f"""WITH {fx.USER_METRICS_SQL}, long AS ({_LONG_METRICS})
    SELECT model_id, half, metric, value, CASE metric WHEN 'rmse' THEN 60.0::DOUBLE ELSE 3500.0::DOUBLE END AS threshold,
      value > threshold AS exceeded FROM long"""
)
def threshold_breaches(spark, sf_dir):
    long = metrics_long(fx.user_metrics(spark, sf_dir), ["model_id", "half"])
    return breaches(long, _LIMITS)


def _spoiled(spark, sf_dir):
    """User metrics of which some are missing, not finite or negative."""
    m = F.col("model_id") % 11
    rmse = F.when(m == 1, F.lit(float("nan"))).when(m == 2, F.lit(float("inf"))).when(m == 3, -F.col("rmse")).otherwise(F.col("rmse"))
    keep = F.when(m == 4, F.create_map(F.lit("mse"), F.col("mse"))).otherwise(
        F.create_map(F.lit("rmse"), rmse, F.lit("mse"), F.col("mse"))
    )
    return fx.user_metrics(spark, sf_dir).select(F.concat_ws("/", "model_id", "half").alias("model_name"), keep.alias("metrics"))


@query(
    f"""WITH {fx.USER_METRICS_SQL} SELECT model_id || '/' || half AS model_name, 'rmse' AS metric,
    CASE WHEN model_id % 11 = 3 THEN -rmse END AS value,
    CASE WHEN model_id % 11 IN (1, 2) THEN 'not_finite' WHEN model_id % 11 = 3 THEN 'negative' ELSE 'missing' END AS kind
    FROM user_metrics WHERE model_id % 11 IN (1, 2, 3, 4)"""
)
def metric_violations(spark, sf_dir):
    found = unsound_metrics(_spoiled(spark, sf_dir))
    shown = F.when(F.col("kind") == "negative", F.col("value"))
    return found.select("model_name", "metric", shown.alias("value"), "kind")


def _trials(spark, sf_dir):
    """Every user is a trial of one of four groups; coarse scores make ties, some scores are unusable."""
    m = F.col("model_id") % 7
    score = F.when(m == 1, F.lit(float("nan"))).when(m == 2, F.lit(None).cast("double")).otherwise(F.round("baseline_rmse", 0))
    return fx.user_halves(spark, sf_dir).select(
        (F.col("model_id") % 4).alias("search_id"),
        F.col("model_id").alias("ordinal"),
        F.concat(F.lit("user_"), F.col("model_id")).alias("model_name"),
        score.alias("rmse"),
    )


_TRIALS_SQL = f"""{fx.USER_HALVES_SQL}, trials AS (SELECT model_id % 4 AS search_id, model_id AS ordinal, 'user_' || model_id AS model_name,
  CASE WHEN model_id % 7 = 1 THEN 'nan'::DOUBLE WHEN model_id % 7 = 2 THEN NULL ELSE round(baseline_rmse, 0) END AS rmse FROM user_halves)"""


@query(
    f"""WITH {_TRIALS_SQL} SELECT * FROM trials WHERE rmse IS NOT NULL AND isfinite(rmse)
    QUALIFY row_number() OVER (PARTITION BY search_id ORDER BY rmse, ordinal) = 1"""
)
def select_best(spark, sf_dir):
    return best_of(_trials(spark, sf_dir), by=["search_id"])


@query(
    f"""WITH {_TRIALS_SQL} SELECT * FROM trials
    QUALIFY row_number() OVER (PARTITION BY search_id ORDER BY coalesce(rmse, 'inf'::DOUBLE), ordinal) = 1"""
)
def select_best_lenient(spark, sf_dir):
    return best_of_lenient(_trials(spark, sf_dir), by=["search_id"])


def _contenders(spark, sf_dir):
    # the first user of each group is its baseline
    return _trials(spark, sf_dir).withColumn("rmse", F.nanvl("rmse", F.lit(None).cast("double"))).withColumn(
        "is_baseline", F.col("ordinal") < 4
    )


_CHAMPIONS_SQL = f"""{_TRIALS_SQL}, contenders AS (SELECT search_id, ordinal, model_name, CASE WHEN isnan(rmse) THEN NULL ELSE rmse END AS rmse, ordinal < 4 AS is_baseline FROM trials),
  baselines AS (SELECT search_id, rmse AS base_rmse FROM contenders WHERE is_baseline),
  champions AS (SELECT search_id, ordinal, model_name, rmse, is_baseline FROM contenders JOIN baselines USING (search_id)
    WHERE is_baseline OR rmse < base_rmse
    QUALIFY row_number() OVER (PARTITION BY search_id ORDER BY is_baseline, rmse, ordinal) = 1)"""


@query(f"WITH {_CHAMPIONS_SQL} SELECT * FROM champions")
def champion_vs_baseline(spark, sf_dir):
    return champion_or_baseline(_contenders(spark, sf_dir), by=["search_id"])


@query(
    f"""WITH {_CHAMPIONS_SQL} SELECT search_id, count(*) AS n_candidates, c.model_name AS champion_id, round(c.rmse, 4) AS champion_rmse,
      count(*) FILTER (WHERE t.rmse < b.base_rmse) AS n_better FROM contenders t JOIN champions c USING (search_id) JOIN baselines b USING (search_id)
      WHERE NOT t.is_baseline GROUP BY ALL"""
)
def comparison_report(spark, sf_dir):
    """Champion of each group, with how many candidates there were and how many beat the baseline."""
    rows = materialize(_contenders(spark, sf_dir), "contenders")
    winners = champion_or_baseline(rows, by=["search_id"]).select(
        "search_id", F.col("model_name").alias("champion_id"), F.round("rmse", 4).alias("champion_rmse")
    )
    base = F.broadcast(rows.where("is_baseline").select("search_id", F.col("rmse").alias("base_rmse")))  # four rows
    beaten = rows.where("not is_baseline").join(base, "search_id")
    counts = beaten.groupBy("search_id").agg(
        F.count(F.lit(1)).alias("n_candidates"), F.count_if(F.col("rmse") < F.col("base_rmse")).alias("n_better")
    )
    return counts.join(winners, "search_id")


# --- registry, runs, reports -------------------------------------------------------------------


@query(
    """SELECT 'v' || (event_id + 1) AS version, event_type AS model_name, 'models/' || event_type || '_' || event_id AS model_path,
    value AS rmse, 'champion' AS stage FROM events ORDER BY event_id DESC LIMIT 1"""
)
def registry_champion(spark, sf_dir):
    """Every event registers a model; v10 is newer than v9."""
    rows = fx.events(spark, sf_dir).select(
        F.concat(F.lit("v"), F.col("event_id") + 1).alias("version"),
        F.col("event_type").alias("model_name"),
        F.concat(F.lit("models/"), F.col("event_type"), F.lit("_"), F.col("event_id")).alias("model_path"),
        F.create_map(F.lit("rmse"), F.col("value")).alias("metrics"),
        F.lit("champion").alias("stage"),
        F.col("ts").cast("string").alias("created_at"),
    )
    best = champion(rows)
    return best.select("version", "model_name", "model_path", F.col("metrics")["rmse"].alias("rmse"), "stage")


@query(
    f"""WITH {fx.USER_METRICS_SQL}, long AS ({_LONG_METRICS})
    SELECT 'user_' || model_id AS model_name, half AS run_id, metric, value FROM long"""
)
def trial_metrics_log(spark, sf_dir):
    """Trial metrics appended to their table by two runs, read back in long form."""
    path = scratch_path(spark, "trial-metrics")
    rows = fx.user_metrics(spark, sf_dir).select(
        F.col("half").alias("run_id"),
        F.concat(F.lit("user_"), F.col("model_id")).alias("model_name"),
        F.lit("N/A").alias("model_uri"),
        F.create_map(F.lit("rmse"), F.col("rmse"), F.lit("mse"), F.col("mse")).alias("metrics"),
        F.lit(None).cast("map<string,string>").alias("hyperparameters"),
        F.lit(None).cast("map<string,string>").alias("training_params"),
        F.col("last_ts").cast("string").alias("timestamp"),
    )
    rows = materialize(rows, "trial-rows")
    for run in ("baseline", "live"):
        rows.where(F.col("run_id") == run).write.mode("append").parquet(path)
    table = read_table(spark, path, TRIAL_METRICS_SCHEMA)
    return table.select("model_name", "run_id", F.explode("metrics").alias("metric", "value"))


_TYPE_SPREAD_SQL = "SELECT event_type AS model_name, stddev_pop(value) AS rmse FROM events GROUP BY 1"


def _type_trials(spark, sf_dir) -> list[Trial]:
    """Each event type is a trial; its error is the spread of its values. Five rows, in order of their names."""
    spread = fx.events(spark, sf_dir).groupBy("event_type").agg(F.stddev_pop("value").alias("rmse")).orderBy("event_type").collect()
    return [
        Trial(i, f"run_{i}", ModelDefinition(r["event_type"], "elastic_net", {"alpha": i}), {"rmse": r["rmse"]}, "success", f"models/{r['event_type']}")
        for i, r in enumerate(spread)
    ]


@query(f"SELECT model_name, 'models/' || model_name AS model_uri, round(rmse, 6) AS rmse FROM ({_TYPE_SPREAD_SQL})")
def trial_log_roundtrip(spark, sf_dir):
    """Trials through the log's own writer, read back."""
    path = scratch_path(spark, "trial-log")
    log_trials(spark, path, _type_trials(spark, sf_dir), {"slice": "all"})
    table = read_table(spark, path, TRIAL_METRICS_SCHEMA)
    return table.select("model_name", "model_uri", F.round(F.col("metrics")["rmse"], 6).alias("rmse"))


@query(
    f"""WITH t AS ({_TYPE_SPREAD_SQL}), b AS (SELECT rmse AS base FROM t ORDER BY model_name LIMIT 1),
    w AS (SELECT model_name FROM t, b WHERE rmse < base OR model_name = (SELECT min(model_name) FROM t) ORDER BY rmse, model_name LIMIT 1)
    SELECT t.model_name AS model_id, CASE WHEN t.model_name = (SELECT min(model_name) FROM t) THEN 'baseline' ELSE 'candidate' END AS role,
      t.model_name = w.model_name AS is_champion, w.model_name AS registered, round(t.rmse, 6) AS rmse FROM t, w"""
)
def promote_results(spark, sf_dir):
    """The first event type is the baseline; the winner is reported and registered, and both tables are read back."""
    base = scratch_path(spark, "promote")
    made = [candidate(t) for t in _type_trials(spark, sf_dir)]
    promote_from_results(spark, made[0], made[1:], "rmse", f"{base}/reports", f"{base}/registry")
    winner = load_champion(spark, f"{base}/registry")["model_name"]
    report = read_table(spark, f"{base}/reports", COMPARISON_SCHEMA)
    return report.select("model_id", "role", "is_champion", F.lit(winner).alias("registered"), F.round(F.col("metrics")["rmse"], 6).alias("rmse"))


@query(
    """WITH phases AS (SELECT user_id AS run_id, event_type AS phase, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS duration_ms,
      CASE WHEN max(value) > 150 THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM events GROUP BY ALL)
    SELECT run_id, CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED' ELSE 'SUCCESS' END AS run_status, count(*) AS n_phases,
      count(*) FILTER (WHERE status = 'FAILED') AS n_failed, CAST(sum(duration_ms) AS BIGINT) AS total_ms, max(duration_ms) AS longest_ms,
      arg_max(phase, (duration_ms, phase)) AS longest_phase FROM phases GROUP BY run_id"""
)
def run_phase_durations(spark, sf_dir):
    from wattline.functions.calendar import wall_micros

    span = wall_micros(F.max("ts")) - wall_micros(F.min("ts"))
    phases = fx.events(spark, sf_dir).groupBy(F.col("user_id").alias("run_id"), F.col("event_type").alias("phase")).agg(
        F.floor(span / 1000).cast("bigint").alias("duration_ms"),
        F.when(F.max("value") > 150, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
    )
    return phase_durations(phases)


# --- drift -------------------------------------------------------------------------------------


def _pairs(spark, sf_dir):
    halves = fx.user_halves(spark, sf_dir)
    both = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.col(f"baseline_{m}").alias("baseline"), F.col(f"live_{m}").alias("live"))
            for m in ("rmse", "mse")
        ]
    )
    return halves.select("model_id", "last_ts", F.inline(both))


_PAIRS_SQL = f"""{fx.USER_HALVES_SQL}, pairs AS (SELECT model_id, last_ts, 'rmse' AS metric, baseline_rmse AS baseline, live_rmse AS live FROM user_halves
  UNION ALL SELECT model_id, last_ts, 'mse', baseline_mse, live_mse FROM user_halves)"""
_DRIFT_SQL = "CASE WHEN baseline = 0 THEN false ELSE (live - baseline) / baseline > 0.1::DOUBLE END"


@query(
    f"""WITH {_PAIRS_SQL} SELECT model_id, metric, baseline, live,
    CASE WHEN baseline <> 0 THEN (live - baseline) / baseline END AS relative_change, {_DRIFT_SQL} AS drift_detected FROM pairs"""
)
def drift_flag(spark, sf_dir):
    found = detect_drift(_pairs(spark, sf_dir))
    return found.select(
        "model_id", "metric", "baseline", "live",
        "relative_change", "drift_detected",
    )


@query(
    f"""WITH {_PAIRS_SQL} SELECT model_id, metric, baseline, live, 1.1::DOUBLE AS ratio,
    live > baseline * 1.1::DOUBLE AS exceeded FROM pairs"""
)
def drift_ratios(spark, sf_dir):
    found = above_ratio(_pairs(spark, sf_dir), DRIFT_RATIOS)
    return found.select(
        "model_id", "metric", "baseline", "live", "ratio", "exceeded"
    )


def _reports(spark, sf_dir):
    """One monitoring report per user, made when its last event came."""
    found = detect_drift(_pairs(spark, sf_dir).where("metric = 'rmse'"))
    return found.select(
        F.concat(F.lit("run_"), F.col("model_id")).alias("run_id"),
        F.col("last_ts").cast("string").alias("timestamp"),
        F.concat(F.lit("v"), F.col("model_id")).alias("model_version"),
        "drift_detected",
        F.create_map(F.lit("rmse"), F.col("baseline")).alias("baseline_metrics"),
        F.create_map(F.lit("rmse"), F.col("live")).alias("live_metrics"),
    )


_REPORTS_SQL = f"""{_PAIRS_SQL}, reports AS (SELECT 'run_' || model_id AS run_id, last_ts, 'v' || model_id AS model_version, {_DRIFT_SQL} AS drift_detected,
  baseline AS baseline_rmse, live AS live_rmse FROM pairs WHERE metric = 'rmse')"""


@query(f"WITH {_REPORTS_SQL} SELECT run_id, model_version, drift_detected, baseline_rmse, live_rmse FROM reports")
def drift_report(spark, sf_dir):
    """Reports written to their table and read back."""
    path = scratch_path(spark, "reports")
    _reports(spark, sf_dir).write.mode("append").parquet(path)
    table = read_table(spark, path, REPORT_SCHEMA)
    return table.select(
        "run_id", "model_version", "drift_detected",
        F.col("baseline_metrics")["rmse"].alias("baseline_rmse"),
        F.col("live_metrics")["rmse"].alias("live_rmse"),
    )


@query(f"WITH {_REPORTS_SQL} SELECT run_id, model_version, drift_detected FROM reports ORDER BY last_ts DESC, run_id DESC LIMIT 1")
def latest_report(spark, sf_dir):
    return newest_report(_reports(spark, sf_dir)).select("run_id", "model_version", "drift_detected")


@query(
    f"""WITH {_REPORTS_SQL} SELECT model_version, run_id, drift_detected AS alert, drift_detected AS retrain_required FROM reports"""
)
def retrain_decision(spark, sf_dir):
    """The newest report of every model version, and what it asks for."""
    newest = newest_report(_reports(spark, sf_dir), "model_version")
    return decide(newest).select("model_version", "run_id", "alert", "retrain_required")


# --- jobs --------------------------------------------------------------------------------------


def _train(spark, sf_dir, base: str, definition: ModelDefinition, features=None):
    """The training job on the raw file, with one definition; all features unless some are named."""
    raw = scan_file(spark, raw_file(spark, sf_dir), Contract(RAW, "raw"))
    options = TrainOptions(base, train_end=fx.TRAIN_END, val_end=fx.VAL_END, definitions=[definition], features=features)
    return raw, train_job(raw, options)


def _train_net(spark, sf_dir, base: str):
    """The one model that has a closed form on one feature."""
    return _train(spark, sf_dir, base, NET, ["hour_of_day"])


_RAW_NET_SQL = f"{fx.RAW_ENGINEERED_SQL}, train AS (SELECT * FROM engineered WHERE {_TRAIN}), {fx.elastic_net_sql('train')}"


@query(
    f"""WITH {_RAW_NET_SQL} SELECT CASE WHEN timestamp < TIMESTAMP '{fx.TRAIN_END}' THEN 'txt' ELSE 'csv' END AS ending, timestamp,
    round(b + w * hour(timestamp), 3) AS prediction FROM exact_readings, net"""
)
def batch_predict(spark, sf_dir):
    """Train, register, load the champion, score a directory of files."""
    base = scratch_path(spark, "batch")
    _train_net(spark, sf_dir, base)
    out = score_job(spark, reading_files(spark, sf_dir), f"{base}/registry", f"{base}/predictions")
    ending = F.regexp_extract("source_file", r"\.(\w+)$", 1).alias("ending")
    return spark.read.parquet(out).select(ending, "timestamp", F.round("prediction", 3).alias("prediction"))


_RAW_CELLS_SQL = f"""{fx.RAW_ENGINEERED_SQL}, train AS (SELECT * FROM engineered WHERE {_TRAIN}), whole AS (SELECT avg(total_load) AS mean FROM train),
    cells AS (SELECT hour_of_day, day_of_week, is_weekend, avg(total_load) AS cell_mean FROM train GROUP BY ALL),
    guesses AS (SELECT c.timestamp, mean + (cell_mean - mean) * (1 - pow(1 - 0.03::DOUBLE, 300)) AS prediction
      FROM (SELECT timestamp, {fx.CALENDAR_SQL} FROM exact_readings) c LEFT JOIN cells USING (hour_of_day, day_of_week, is_weekend) CROSS JOIN whole)"""


def _seen(train, guesses):
    """Predictions of calendar cells that the training slice has; what a tree says of others has no closed form, and is shown as null."""
    cells = train.select(*FEATURES, F.lit(True).alias("seen")).distinct()
    stamp = F.col("timestamp")
    placed = guesses.select(
        "*", F.hour(stamp).cast("bigint").alias("hour_of_day"), F.weekday(stamp).cast("bigint").alias("day_of_week"), (F.weekday(stamp) >= 5).cast("bigint").alias("is_weekend")
    )
    met = placed.join(F.broadcast(cells), FEATURES, "left")  # at most 168 cells
    return met.withColumn("prediction", F.when(F.col("seen"), F.round("prediction", 3))).drop("seen", *FEATURES)


@query(
    f"""WITH {_RAW_CELLS_SQL} SELECT CASE WHEN timestamp < TIMESTAMP '{fx.TRAIN_END}' THEN 'txt' ELSE 'csv' END AS ending, timestamp,
    round(prediction, 3) AS prediction FROM guesses"""
)
def batch_predict_boosted(spark, sf_dir):
    """The batch job with a leaf-wise champion of 300 rounds on all features."""
    base = scratch_path(spark, "batch-boosted")
    _, result = _train(spark, sf_dir, base, _PARTING["lgbm"])
    train, _, _ = split_frames(spark.read.parquet(result.engineered), fx.TRAIN_END, fx.VAL_END)
    out = score_job(spark, reading_files(spark, sf_dir), f"{base}/registry", f"{base}/predictions")
    ending = F.regexp_extract("source_file", r"\.(\w+)$", 1).alias("ending")
    return _seen(train, spark.read.parquet(out).select(ending, "timestamp", "prediction"))


_ERROR_SQL = "sqrt(avg((total_load - (b + w * hour_of_day)) ^ 2))"
_RIDGE_ERROR_SQL = f"sqrt(avg((total_load - ({_RIDGE_GUESS})) ^ 2))"


def _monitored(spark, base: str, raw):
    options = MonitorOptions(f"{base}/registry", f"{base}/reports", f"{base}/run_phases", PrepareOptions(), fx.VAL_END)
    monitor_job(raw, options)
    report = read_table(spark, f"{base}/reports", REPORT_SCHEMA)
    return report.select(
        "model_version",
        F.round(F.col("baseline_metrics")["rmse"], 3).alias("baseline_rmse"),
        F.round(F.col("live_metrics")["rmse"], 3).alias("live_rmse"),
        "drift_detected",
    )


@query(
    f"""WITH {fx.RAW_ENGINEERED_SQL}, train AS (SELECT * FROM engineered WHERE {_TRAIN}), {_ridge_sql('train')},
    base AS (SELECT {_RIDGE_ERROR_SQL} AS rmse FROM engineered, net WHERE {_VALIDATION}),
    live AS (SELECT {_RIDGE_ERROR_SQL} AS rmse FROM engineered, net WHERE timestamp > TIMESTAMP '{fx.VAL_END}')
    SELECT 'v1' AS model_version, round(base.rmse, 3) AS baseline_rmse, round(live.rmse, 3) AS live_rmse,
      (live.rmse - base.rmse) / base.rmse > 0.1::DOUBLE AS drift_detected FROM base, live"""
)
def monitor_live_all(spark, sf_dir):
    """The monitoring job with a champion on all features."""
    base = scratch_path(spark, "monitor-all")
    raw, _ = _train(spark, sf_dir, base, RIDGE)
    return _monitored(spark, base, raw)


@query()
def monitor_live_boosted(spark, sf_dir):
    """The monitoring job with the best of the default definitions as champion."""
    base = scratch_path(spark, "monitor-boosted")
    raw = scan_file(spark, raw_file(spark, sf_dir), Contract(RAW, "raw"))
    train_job(raw, TrainOptions(base, train_end=fx.TRAIN_END, val_end=fx.VAL_END))
    return _monitored(spark, base, raw)


_OUTCOMES = """SELECT * FROM (VALUES ('FAILED', 'data', 'SUCCESS', false), ('FAILED', 'model_search', 'FAILED', true),
    ('SUCCESS', 'data', 'SUCCESS', false), ('SUCCESS', 'model_search', 'SUCCESS', false), ('SUCCESS', 'registry', 'SUCCESS', false))
    v(run_status, phase, status, has_message)"""


@query(f"WITH n AS (SELECT count(*) AS n FROM events) SELECT v.* FROM ({_OUTCOMES}) v, n WHERE n > 0")
def run_log_phases(spark, sf_dir):
    """What two training jobs wrote to their log: one that went through, and one whose only definition cannot be fitted."""
    base = scratch_path(spark, "run-log")
    raw, _ = _train(spark, sf_dir, base, NET)
    try:
        _train(spark, sf_dir, base, _BROKEN)
    except TrainingError:
        pass
    phases = read_table(spark, f"{base}/run_phases", RUN_PHASES_SCHEMA).where("duration_ms >= 0 and ended_at >= started_at")
    return phases.select("run_status", "phase", "status", F.col("error_message").isNotNull().alias("has_message"))


@query(
    f"""WITH {_RAW_NET_SQL},
    base AS (SELECT {_ERROR_SQL} AS rmse FROM engineered, net WHERE {_VALIDATION}),
    live AS (SELECT {_ERROR_SQL} AS rmse FROM engineered, net WHERE timestamp > TIMESTAMP '{fx.VAL_END}')
    SELECT 'v1' AS model_version, round(base.rmse, 3) AS baseline_rmse, round(live.rmse, 3) AS live_rmse,
      (live.rmse - base.rmse) / base.rmse > 0.1::DOUBLE AS drift_detected FROM base, live"""
)
def monitor_live(spark, sf_dir):
    """Train, register, then monitor the champion on the live slice and read the report."""
    base = scratch_path(spark, "monitor")
    raw, _ = _train_net(spark, sf_dir, base)
    return _monitored(spark, base, raw)


# --- streams -----------------------------------------------------------------------------------


@query(
    f"WITH {_NET_SQL} SELECT timestamp, round(b + w * hour(timestamp), 3) AS prediction FROM exact_readings, net"
)
def stream_score(spark, sf_dir):
    train, _, _ = _slices(spark, sf_dir)
    model = fit(NET, train, ["hour_of_day"])
    base = scratch_path(spark, "stream-score")
    source = fx.readings_raw(spark, sf_dir)
    source.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(source.schema).parquet(f"{base}/in")
    run_available(score_stream(stream, model), f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select("timestamp", F.round("prediction", 3).alias("prediction"))


@query(
    f"""WITH {fx.ENGINEERED_SQL}, train AS (SELECT * FROM engineered WHERE {_TRAIN}), whole AS (SELECT avg(total_load) AS mean FROM train),
    cells AS (SELECT hour_of_day, day_of_week, is_weekend, avg(total_load) AS cell_mean FROM train GROUP BY ALL)
    SELECT c.timestamp, round(mean + (cell_mean - mean) * (1 - pow(1 - 0.05::DOUBLE, 300)), 3) AS prediction
    FROM (SELECT timestamp, {fx.CALENDAR_SQL} FROM exact_readings) c LEFT JOIN cells USING (hour_of_day, day_of_week, is_weekend) CROSS JOIN whole"""
)
def stream_score_boosted(spark, sf_dir):
    """A stream scored by boosted trees on all features: a lookup in the JVM."""
    train, _, _ = _slices(spark, sf_dir)
    model = fit(_PARTING["gbm"], train, FEATURES)
    base = scratch_path(spark, "stream-boosted")
    source = fx.readings_raw(spark, sf_dir)
    source.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(source.schema).parquet(f"{base}/in")
    run_available(score_stream(stream, model), f"{base}/out", f"{base}/checkpoint")
    return _seen(train, spark.read.parquet(f"{base}/out").select("timestamp", "prediction"))


_TYPE_MEANS_SQL = "types AS (SELECT event_type, avg(value) AS prediction FROM events GROUP BY 1)"


@query(
    f"""WITH {_TYPE_MEANS_SQL}, scored AS (SELECT ts, value AS label, prediction FROM events JOIN types USING (event_type)),
    base AS (SELECT sqrt(avg((label - prediction) ^ 2)) AS rmse FROM scored WHERE ts < TIMESTAMP '{fx.TRAIN_END}'),
    days AS (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, count(*) AS n_rows, avg((label - prediction) ^ 2) AS mse FROM scored GROUP BY 1)
    SELECT window_start, n_rows, round(sqrt(mse), 4) AS rmse, round(mse, 3) AS mse, (sqrt(mse) - base.rmse) / base.rmse > 0.1::DOUBLE AS drift_detected
    FROM days, base WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"""
)
def stream_live_metrics(spark, sf_dir):
    """Daily windows that the watermark has closed."""
    rows = fx.events(spark, sf_dir)
    # one row per event type, of which there are five
    types = rows.groupBy("event_type").agg(F.avg("value").alias("prediction"))
    types = F.broadcast(materialize(types, "types"))
    early = rows.where(F.col("ts") < F.lit(fx.TRAIN_END).cast("timestamp_ntz")).join(types, "event_type")
    baseline = evaluate(early.withColumn("label", F.col("value")), (), ["rmse"]).first()["rmse"]
    stream = spark.readStream.schema(rows.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    scored = stream.join(types, "event_type").select("ts", F.col("value").alias("label"), "prediction")
    base = scratch_path(spark, "stream-metrics")
    run_available(live_metrics(scored, baseline), f"{base}/out", f"{base}/checkpoint")
    windows = spark.read.parquet(f"{base}/out")
    return windows.select(
        "window_start", "n_rows", F.round("rmse", 4).alias("rmse"), F.round("mse", 3).alias("mse"), "drift_detected"
    )


@query(
    f"""WITH {fx.LONG_SQL} SELECT meter_id, event_id, timestamp,
    last_value(value IGNORE NULLS) OVER (PARTITION BY meter_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING) AS value FROM readings_long"""
)
def stream_fill(spark, sf_dir):
    """Three arrivals; the stream stops after each and goes on from its checkpoint."""
    rows = fx.readings_long(spark, sf_dir)
    base = scratch_path(spark, "stream-fill")
    fill = StreamFill(base, tie="event_id")
    bounds = [F.lit(b).cast("timestamp_ntz") for b in ("2024-01-10", "2024-01-20")]
    arrival = F.when(F.col("timestamp") < bounds[0], 0).when(F.col("timestamp") < bounds[1], 1).otherwise(2)
    for part in range(3):
        rows.where(arrival == part).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        fill.start(stream).awaitTermination()
    return fill.result(spark).select("meter_id", "event_id", "timestamp", "value")


# arrivals of the streams below: two parts in order of time, then every tenth event late
_ARRIVAL_SQL = "CASE WHEN event_id % 10 = 3 THEN 2 WHEN ts < TIMESTAMP '2024-01-12' THEN 0 ELSE 1 END"
_LATE_SQL = f"""arrived AS (SELECT *, {_ARRIVAL_SQL} AS part FROM events),
    mark AS (SELECT max(ts) - INTERVAL 1 HOUR AS closed FROM arrived WHERE part < 2),
    placed AS (SELECT arrived.*, part = 2 AND date_trunc('day', ts) + INTERVAL 1 DAY <= closed AS late FROM arrived, mark)"""


def _metrics_run(spark, sf_dir):
    """The live metrics of three arrivals; the stream stops after each and goes on from its checkpoint."""
    rows = fx.events(spark, sf_dir)
    types = F.broadcast(materialize(rows.groupBy("event_type").agg(F.avg("value").alias("prediction")), "types"))  # five rows
    scored = rows.join(types, "event_type").select("ts", F.col("value").alias("label"), "prediction", "event_id")
    early = scored.where(F.col("ts") < F.lit(fx.TRAIN_END).cast("timestamp_ntz"))
    baseline = evaluate(early, (), ["rmse"]).first()["rmse"]
    base = scratch_path(spark, "stream-metrics-all")
    job = LiveMetrics(base, baseline)
    arrival = F.when(F.col("event_id") % 10 == 3, 2).when(F.col("ts") < F.lit("2024-01-12").cast("timestamp_ntz"), 0).otherwise(1)
    for part in range(3):
        scored.where(arrival == part).write.mode("append").parquet(f"{base}/in")
        job.start(spark.readStream.schema(scored.schema).parquet(f"{base}/in")).awaitTermination()
    return job


@query(
    f"""WITH {_TYPE_MEANS_SQL}, {_LATE_SQL}, scored AS (SELECT ts, value AS label, prediction, late FROM placed JOIN types USING (event_type)),
    base AS (SELECT sqrt(avg((label - prediction) ^ 2)) AS rmse FROM scored WHERE ts < TIMESTAMP '{fx.TRAIN_END}'),
    newest AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events),
    days AS (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, count(*) AS n_rows, avg((label - prediction) ^ 2) AS mse FROM scored WHERE NOT late GROUP BY 1)
    SELECT window_start, n_rows, round(sqrt(mse), 4) AS rmse, round(mse, 3) AS mse, (sqrt(mse) - base.rmse) / base.rmse > 0.1::DOUBLE AS drift_detected,
      window_start + INTERVAL 1 DAY <= mark AS is_final FROM days, base, newest"""
)
def stream_live_metrics_all(spark, sf_dir):
    """All windows, the open ones too."""
    found = _metrics_run(spark, sf_dir).result(spark)
    return found.select("window_start", "n_rows", F.round("rmse", 4).alias("rmse"), F.round("mse", 3).alias("mse"), "drift_detected", "is_final")


@query(f"WITH {_LATE_SQL} SELECT event_id, ts FROM placed WHERE late")
def stream_late_rows(spark, sf_dir):
    """Rows that came after their window had closed."""
    return _metrics_run(spark, sf_dir).late_rows(spark).select("event_id", "ts")


@query(
    f"""WITH {fx.LONG_SQL} SELECT meter_id, event_id, timestamp,
    last_value(value IGNORE NULLS) OVER (PARTITION BY meter_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING) AS value FROM readings_long"""
)
def stream_fill_restated(spark, sf_dir):
    """Readings come up to six hours late, out of order; what they correct is stated again."""
    rows = fx.readings_long(spark, sf_dir)
    base = scratch_path(spark, "stream-restated")
    fill = RestatedFill(base, 8 * 3600, tie="event_id")
    comes = F.col("timestamp") + F.make_dt_interval(hours=(F.col("event_id") * 37 % 7).cast("int"))
    bounds = [F.lit(b).cast("timestamp_ntz") for b in ("2024-01-10", "2024-01-20")]
    arrival = F.when(comes < bounds[0], 0).when(comes < bounds[1], 1).otherwise(2)
    for part in range(3):
        rows.where(arrival == part).write.mode("append").parquet(f"{base}/in")
        fill.start(spark.readStream.schema(rows.schema).parquet(f"{base}/in")).awaitTermination()
    return fill.result(spark).select("meter_id", "event_id", "timestamp", "value")


_TYPE_RECORDS_SQL = f"SELECT model_name, row_number() OVER (ORDER BY model_name) AS n, round(rmse, 6) AS rmse FROM ({_TYPE_SPREAD_SQL})"


@query(f"SELECT 'v' || n AS version, model_name, rmse, n = max(n) OVER () AS is_champion FROM ({_TYPE_RECORDS_SQL})")
def registry_commits(spark, sf_dir):
    """Each event type registers a model in a commit of its own; the newest is champion."""
    path = scratch_path(spark, "registry-commits")
    for t in _type_trials(spark, sf_dir):
        register(spark, path, t.definition.name, t.model_path, t.metrics, "now")
    newest = load_champion(spark, path)["version"]
    return registry_records(spark, path).select("version", "model_name", F.round(F.col("metrics")["rmse"], 6).alias("rmse"), (F.col("version") == newest).alias("is_champion"))
