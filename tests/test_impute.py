import random

import pytest

from helpers import at
from wattline.errors import OptionError
from wattline.operators.impute import fill_median, fill_mode, impute_long, mode_of
from wattline.operators.quantile import exact_median

DDL = "meter_id int, timestamp timestamp_ntz, value double"


def data(n=400, seed=5):
    draw = random.Random(seed)
    made = []
    for i in range(n):
        meter = 0 if draw.random() < 0.4 else draw.randint(1, 4)
        value = None if draw.random() < 0.2 else draw.choice([1.0, 2.5, 1e300, -7.0, draw.random() * 1000])
        made.append((meter, at(i), value))
    return made


def brute_median(values):
    ordered = sorted(values)
    middle = len(ordered) // 2
    return ordered[middle] if len(ordered) % 2 else (ordered[middle - 1] + ordered[middle]) / 2


@pytest.mark.parametrize("hot_rows", [2_000_000, 100, 10, 1])
def test_median_is_exact_for_hot_keys(spark, hot_rows):
    made = data()
    got = {r[0]: r[1] for r in exact_median(spark.createDataFrame(made, DDL), ["meter_id"], "value", hot_rows).collect()}
    for meter in {m for m, _, _ in made}:
        want = brute_median([v for m, _, v in made if m == meter and v is not None])
        assert got[meter] == pytest.approx(want, rel=1e-12), meter


@pytest.mark.parametrize("values, want", [([3.0], 3.0), ([1.0, 2.0], 1.5), ([5.0] * 7, 5.0), ([float("inf"), 1.0, float("-inf")], 1.0), ([1.0] * 5 + [9.0] * 5, 5.0)])
def test_median_of_few_values(spark, values, want):
    df = spark.createDataFrame([(1, at(i), v) for i, v in enumerate([*values, None, float("nan")])], DDL)
    assert [r[1] for r in exact_median(df, ["meter_id"], "value", 1).collect()] == [want]
    assert [r[1] for r in exact_median(df, ["meter_id"], "value").collect()] == [want]


def test_median_fill_leaves_a_meter_without_values_alone(spark):
    df = spark.createDataFrame([(1, at(0), 1.0), (1, at(1), None), (1, at(2), 4.0), (2, at(0), None)], DDL)
    got = sorted((r["meter_id"], r["timestamp"], r["value"]) for r in fill_median(df).collect() if r["meter_id"] == 1)
    assert [v for _, _, v in got] == [1.0, 2.5, 4.0]
    assert [r["value"] for r in fill_median(df).collect() if r["meter_id"] == 2] == [None]


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([(1, at(i), v) for i, v in enumerate([3.0, 3.0, 2.0, 2.0, 9.0, None])] + [(2, at(0), -1.0)], DDL)
    assert sorted(tuple(r) for r in mode_of(df, ["meter_id"], "value").collect()) == [(1, 2.0), (2, -1.0)]
    assert [r["value"] for r in fill_mode(df).orderBy("meter_id", "timestamp").collect()] == [3.0, 3.0, 2.0, 2.0, 9.0, 2.0, -1.0]


def test_strategies(spark):
    df = spark.createDataFrame([(1, at(0), 1.0), (1, at(1), None)], DDL)
    for strategy in ("forward_fill", "median", "mode"):
        assert impute_long(df, strategy).where("value is null").isEmpty()
    assert impute_long(df, "none") is df
    with pytest.raises(OptionError):
        impute_long(df, "magic")
