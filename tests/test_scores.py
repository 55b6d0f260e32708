import math

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from wattline.errors import OptionError, TrainingError
from wattline.operators.drift import detect_drift, drift_ratios, latest_report, retrain_decision
from wattline.operators.evaluate import evaluate, evaluate_one, metric_violations, metrics_long, threshold_breaches
from wattline.operators.profile import clean_checks, decimal_format, first_rows, profile_columns, total_load_check
from wattline.operators.select import champion_vs_baseline, select_best, select_best_lenient

NAN, INF = float("nan"), float("inf")


def test_errors_per_model(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 3.0), ("b", 0.0, 2.0)], "m string, label double, prediction double")
    assert rows(evaluate(df, ["m"]), "m") == [("a", 2, 0, math.sqrt(0.5), 0.5), ("b", 1, 0, 2.0, 4.0)]
    assert "Python" not in plan_of(evaluate(df, ["m"]))


def test_unusable_rows_are_errors(spark):
    df = spark.createDataFrame([(1.0, NAN)], "label double, prediction double")
    for bad in (df, df.limit(0), spark.createDataFrame([(1.0, None)], df.schema)):
        with pytest.raises(TrainingError):
            evaluate_one(bad)
    with pytest.raises(OptionError):
        evaluate(df, (), ["mae"])


def test_threshold_is_passed_only_from_above(spark):
    wide = spark.createDataFrame([("a", 10.0, 5.0), ("b", 10.1, None)], "m string, rmse double, mse double")
    got = threshold_breaches(metrics_long(wide, ["m"]), {"rmse": 10.0})
    assert rows(got, "m") == [("a", "rmse", 10.0, 10.0, False), ("b", "rmse", 10.1, 10.0, True)]


def test_metric_violations(spark):
    data = [("ok", {"rmse": 1.0, "mse": 1.0}), ("nan", {"rmse": NAN, "mse": 1.0}), ("inf", {"rmse": 1.0, "mse": -INF}), ("neg", {"rmse": -1.0, "mse": -1.0}), ("gone", {"mse": 1.0}), ("null", {"rmse": None, "mse": 1.0})]
    df = spark.createDataFrame(data, "model_name string, metrics map<string,double>")
    got = sorted((r["model_name"], r["metric"], r["kind"]) for r in metric_violations(df).collect())
    assert got == [("gone", "rmse", "missing"), ("inf", "mse", "not_finite"), ("nan", "rmse", "not_finite"), ("neg", "rmse", "negative"), ("null", "rmse", "not_finite")]


TRIALS = "g string, ordinal bigint, model_name string, rmse double"


def test_first_of_the_lowest_wins(spark):
    data = [("a", 0, "nan", NAN), ("a", 1, "late", 2.0), ("a", 2, "tie1", 1.0), ("a", 3, "tie2", 1.0), ("b", 0, "none", None), ("b", 1, "inf", INF)]
    df = spark.createDataFrame(data, TRIALS)
    assert rows(select_best(df, by=["g"]).select("g", "model_name")) == [("a", "tie1")]
    lenient = rows(select_best_lenient(df, by=["g"]).select("g", "model_name"), "g")
    assert lenient == [("a", "tie1"), ("b", "none")]
    assert select_best(df.where("g = 'b'")).isEmpty()
    assert select_best(df.limit(0)).isEmpty() and select_best_lenient(df.limit(0)).isEmpty()


@pytest.mark.parametrize("scores, want", [([5.0, 4.0, 3.0, 3.0], 2), ([5.0, 5.0], 0), ([5.0, NAN, 6.0], 0), ([5.0], 0), ([0.0, -1.0], 1)])
def test_champion_must_be_strictly_better(spark, scores, want):
    df = spark.createDataFrame([(i, f"m{i}", s, i == 0) for i, s in enumerate(scores)], "ordinal bigint, model_name string, rmse double, is_baseline boolean")
    assert champion_vs_baseline(df).first()["ordinal"] == want


@pytest.mark.parametrize("base, live, want", [(100.0, 110.0, False), (100.0, 110.5, True), (0.0, 9.0, False), (100.0, 50.0, False)])
def test_drift(spark, base, live, want):
    df = spark.createDataFrame([(base, live)], "baseline double, live double")
    assert detect_drift(df).first()["drift_detected"] is want


def test_drift_ratios(spark):
    df = spark.createDataFrame([("rmse", 100.0, 111.0), ("mse", 100.0, 100.0), ("mae", 1.0, 9.0)], "metric string, baseline double, live double")
    assert rows(drift_ratios(df).select("metric", "exceeded"), "metric") == [("mse", False), ("rmse", True)]


def test_newest_report_decides(spark):
    df = spark.createDataFrame([("z", "2024-01-01T00:00:00", True), ("a", "2024-02-01T00:00:00", False), ("b", "2024-02-01T00:00:00", True)], "run_id string, timestamp string, drift_detected boolean")
    newest = retrain_decision(latest_report(df)).first()
    assert (newest["run_id"], newest["alert"], newest["retrain_required"]) == ("b", True, True)
    assert latest_report(df.limit(0)).isEmpty()


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "n int, s string")
    assert rows(profile_columns(df)) == [("n", "int32", 2, 2, 0), ("s", "object", 2, 1, 1)]


def test_decimal_format_rules_in_order(spark):
    df = spark.createDataFrame([("1,0", "0", "12", "0.5", "0,0", None), ("2", "0.0", "0", "1", "0", "0")], ", ".join(f"MT_00{i} string" for i in range(1, 7)))
    got = dict(rows(decimal_format(df)))
    assert got == {"MT_001": "comma", "MT_002": "zeros", "MT_003": "whole", "MT_004": "no_comma", "MT_005": "comma", "MT_006": "no_comma"}


def test_clean_checks(spark):
    df = spark.createDataFrame([("0,0", 0.0, "1"), ("5", 5.0, "x")], "r1 string, c1 double, r2 string").withColumn("c2", F.expr("try_cast(r2 as double)"))
    got = {r["column"]: tuple(r)[1:] for r in clean_checks(df, {"one": ("r1", "c1"), "two": ("r2", "c2")}).collect()}
    assert got == {"one": (False, 1, True, 0), "two": (True, 0, False, 1)}


def test_total_load_check_sees_a_difference(spark):
    one = spark.createDataFrame([(1, 2.0), (2, 3.0)], "timestamp int, total_load double")
    two = spark.createDataFrame([(1, 2.0), (2, 3.5)], one.schema)
    assert rows(total_load_check(one, two)) == [(2, 0.5, 0)]
    merged = spark.createDataFrame([(1, 5.0)], one.schema)
    assert rows(total_load_check(spark.createDataFrame([(1, 2.0), (1, 3.0)], one.schema), merged)) == [(1, 0.0, 1)]
    assert "TakeOrdered" in plan_of(first_rows(one))
