import pytest
from pyspark.sql import functions as F

from helpers import START, at, plan_of, rows
from wattline.errors import ContractError, OptionError, WattlineError
from wattline.functions.rowwise import row_aggregate
from wattline.operators.features import dropped_columns, engineer_wide, feature_projection, total_by_time, with_time_features
from wattline.operators.clean import to_long
from wattline.operators.split import feature_columns, features_only, split_frames, time_split
from wattline.plans.prepare import PrepareOptions, gated, prepare, rejected_rows

WIDE = "timestamp timestamp_ntz, MT_001 double, MT_002 double, MT_003 double"
DATA = [(at(0), 1.0, None, 3.0), (at(1), None, None, None), (at(2), 0.5, 0.25, -1.0)]


def test_row_aggregates(spark):
    df = spark.createDataFrame(DATA, WIDE)
    meters = ["MT_001", "MT_002", "MT_003"]
    got = {m: [r[0] for r in df.orderBy("timestamp").select(row_aggregate(meters, m)).collect()] for m in ("sum", "mean", "min", "max")}
    assert got["sum"] == [4.0, 0.0, -0.25]
    assert got["mean"] == [2.0, None, pytest.approx(-0.25 / 3)]
    assert got["min"] == [1.0, None, -1.0] and got["max"] == [3.0, None, 0.5]
    assert df.select(row_aggregate(["MT_001"], "max")).count() == 3
    with pytest.raises(OptionError):
        row_aggregate(meters, "median")


@pytest.mark.parametrize("method", ["sum", "mean", "min", "max"])
def test_long_totals_equal_wide_ones(spark, method):
    df = spark.createDataFrame(DATA, WIDE)
    wide = df.select("timestamp", row_aggregate(["MT_001", "MT_002", "MT_003"], method).alias("total_load"))
    assert rows(total_by_time(to_long(df), method), "timestamp") == rows(wide, "timestamp")


def test_row_sum_over_hundreds_of_columns(spark):
    names = [f"MT_{i:03d}" for i in range(1, 371)]
    df = spark.range(3).select(*[F.lit(1.0).alias(n) for n in names])
    assert [r[0] for r in df.select(row_aggregate(names)).collect()] == [370.0] * 3


def test_calendar_at_the_week_border(spark):
    # 2024-01-07 is a Sunday
    stamps = [START.replace(day=6, hour=23), START.replace(day=7, hour=23, minute=45), START.replace(day=8)]
    df = with_time_features(spark.createDataFrame([(s,) for s in stamps], "timestamp timestamp_ntz"))
    assert [tuple(r)[1:] for r in df.orderBy("timestamp").collect()] == [(23, 5, 1), (23, 6, 1), (0, 0, 0)]
    assert [t for _, t in df.dtypes][1:] == ["bigint"] * 3


def test_feature_flags(spark):
    df = spark.createDataFrame([(at(0),)], "timestamp timestamp_ntz")
    assert with_time_features(df, {"hour_of_day": True, "is_weekend": False}).columns == ["timestamp", "hour_of_day"]
    with pytest.raises(OptionError):
        with_time_features(df, {"minute": True})


def test_feature_projection_drops_text_booleans_and_meters(spark):
    df = spark.createDataFrame([(1.0, "x", True, 2, at(0), "y")], "MT_001 double, note string, flag boolean, n int, timestamp timestamp_ntz, total_load string")
    kept = feature_projection(df)
    assert kept.columns == ["timestamp", "n", "total_load"]
    assert dropped_columns(df, kept) == ["MT_001", "flag", "note"]


def test_wide_features_need_no_shuffle(spark):
    assert "Exchange" not in plan_of(engineer_wide(spark.createDataFrame(DATA, WIDE)))


def test_split_bounds_are_midnight_and_inclusive(spark):
    stamps = ["2013-12-30 23:45:00", "2013-12-31 00:00:00", "2013-12-31 00:15:00", "2014-06-30 00:00:00", "2014-06-30 00:15:00", "2015-01-01 00:00:00", None]
    df = spark.createDataFrame([(s, 1.0) for s in stamps], "s string, total_load double").select(F.col("s").cast("timestamp_ntz").alias("timestamp"), "s", "total_load")
    got = {r["s"]: r["split"] for r in time_split(df).collect()}
    assert [got[s] for s in stamps] == ["train", "train", "validation", "validation", "test", "test", None]
    assert [p.count() for p in split_frames(df)] == [2, 2, 2]
    assert split_frames(df, test_end="2014-12-31")[2].count() == 1
    ended = {r["s"]: r["split"] for r in time_split(df, test_end="2014-12-31").collect()}
    assert ended["2015-01-01 00:00:00"] is None


def test_split_filters_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([(at(i), float(i)) for i in range(4)], "timestamp timestamp_ntz, total_load double").write.parquet(f"{tmp_path}/t")
    train, validation, test = split_frames(spark.read.parquet(f"{tmp_path}/t"), "2024-01-02", "2024-01-03")
    for part, sign in ((train, "LessThanOrEqual"), (validation, "GreaterThan"), (test, "GreaterThan")):
        assert f"{sign}(timestamp" in plan_of(part).split("PushedFilters")[1]


def test_split_guards(spark):
    with pytest.raises(OptionError):
        time_split(spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(WattlineError):
        split_frames(spark.createDataFrame([], "timestamp timestamp_ntz"))


def test_model_input_has_no_target_and_no_timestamp(spark):
    df = spark.createDataFrame([(at(0), 1.0, 2)], "timestamp timestamp_ntz, total_load double, hour_of_day bigint")
    assert features_only(df).columns == feature_columns(df) == ["hour_of_day"]
    assert features_only(df.drop("timestamp")).columns == ["hour_of_day"]


def test_routes_agree_and_keys_keep_files_apart(spark):
    data = [("a", at(0), "1,0", None), ("a", at(1), None, "2,5"), ("b", at(2), None, "4"), ("b", at(3), "x", None), ("b", None, "9", "9")]
    df = spark.createDataFrame(data, "source_file string, timestamp timestamp_ntz, MT_001 string, MT_002 string")
    for route in ("wide", "long"):
        options = PrepareOptions(route=route, untimed="reject")
        got = rows(prepare(df, options, ["source_file"]).select("source_file", "timestamp", "total_load"), "timestamp")
        assert got == [("a", at(0), 0.25), ("a", at(1), 0.875), ("b", at(2), 1.0), ("b", at(3), 1.0)]
        with pytest.raises(Exception, match="no timestamp"):
            prepare(df, PrepareOptions(route=route, imputation="none"), ["source_file"]).collect()
        with pytest.raises(OptionError):
            prepare(df, PrepareOptions(route=route, convert=False))
    assert [tuple(r) for r in rejected_rows(df).select("source_file", "MT_001").collect()] == [("b", "9")]
    for options in (PrepareOptions(route="other"), PrepareOptions(untimed="other"), PrepareOptions(route="wide", imputation="magic")):
        with pytest.raises(OptionError):
            prepare(df, options)


@pytest.mark.parametrize("route", ["wide", "long"])
def test_rows_that_share_a_timestamp_stay_apart(spark, route):
    data = [(at(0), "1", "2"), (at(0), "10", "20"), (at(1), "3", None)]
    df = spark.createDataFrame(data, "timestamp timestamp_ntz, MT_001 string, MT_002 string").coalesce(1)
    got = prepare(df, PrepareOptions(route=route, factor=None))
    # the third row takes its missing cell from the later of the two
    assert sorted(r["total_load"] for r in got.collect()) == [3.0, 23.0, 30.0]


@pytest.mark.parametrize("route", ["wide", "long"])
@pytest.mark.parametrize("strategy, want", [("median", 2.0), ("mode", 1.0)])
def test_statistics_stay_inside_a_file(spark, route, strategy, want):
    data = [("a", at(0), 1.0), ("a", at(1), 1.0), ("a", at(2), 3.0), ("a", at(9), None), ("b", at(0), 100.0), ("b", at(1), None)]
    df = spark.createDataFrame(data, "source_file string, timestamp timestamp_ntz, MT_001 double")
    got = prepare(df, PrepareOptions(route=route, factor=None, imputation=strategy), ["source_file"])
    filled = {(r["source_file"], r["timestamp"]): r["total_load"] for r in got.collect()}
    assert filled[("a", at(9))] == 1.0 and filled[("b", at(1))] == 100.0
    alone = prepare(df.drop("source_file"), PrepareOptions(route=route, factor=None, imputation=strategy))
    assert [r["total_load"] for r in alone.orderBy("timestamp").collect()][-1] == want


@pytest.mark.parametrize("imputation, want", [("median", [1.0, 1.0]), ("mode", [1.0, 1.0]), ("none", [1.0, 0.0])])
def test_other_imputations(spark, imputation, want):
    df = spark.createDataFrame([(at(0), "1"), (at(1), None)], "timestamp timestamp_ntz, MT_001 string")
    got = prepare(df, PrepareOptions(imputation=imputation, factor=None))
    assert [r["total_load"] for r in got.orderBy("timestamp").collect()] == want


def test_gates_stop_at_the_first_breach(spark):
    raw = spark.createDataFrame([("2024-01-01 00:00:00", "4,0")], "`Unnamed: 0` string, MT_001 string")
    assert [tuple(r) for r in gated(raw).collect()] == [(START, 1.0, 0, 0, 0)]
    with pytest.raises(ContractError, match="raw"):
        gated(raw.withColumnRenamed("Unnamed: 0", "timestamp"))
    with pytest.raises(ContractError, match="engineered"):
        gated(raw, PrepareOptions(flags={"hour_of_day": True}))
    with pytest.raises(Exception, match="soon"):
        gated(spark.createDataFrame([("soon", "4")], raw.schema)).collect()
