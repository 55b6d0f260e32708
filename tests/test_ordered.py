import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import START, at, plan_of
from wattline.errors import OptionError
from wattline.operators import ordered
from wattline.operators.impute import forward_fill
from wattline.operators.ordered import Near, nearest
from wattline.operators.clean import to_long

DDL = "meter_id int, timestamp timestamp_ntz, reading_id bigint, value double"


def series(n=600, seed=1, hot=0.4, ties=True):
    """Random readings: one meter has much of them, many share a timestamp, a third is missing."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        meter = 0 if draw.random() < hot else draw.randint(1, 5)
        minutes = draw.choice([0, 7, 60 * 24 * 40]) if ties and draw.random() < 0.3 else draw.randint(0, 60 * 24 * 90)
        value = None if draw.random() < 0.35 else float(draw.randint(0, 99))
        out.append((meter, START + timedelta(minutes=minutes), i * 7 - 900, value))
    return out


def brute_fill(data):
    last, out = {}, {}
    for meter, _, reading, value in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        if value is not None:
            last[meter] = value
        out[reading] = last.get(meter)
    return out


@pytest.mark.parametrize("days, chunk_rows", [(32, 2_000_000), (1, 2_000_000), (1000, 40), (3, 5), (32, 1)])
def test_fill_equals_brute_force_wherever_the_cuts_fall(spark, days, chunk_rows):
    data = series()
    df = spark.createDataFrame(data, DDL).repartition(5)
    filled = forward_fill(df, ["value"], ["meter_id"], tie="reading_id", chunk_days=days, chunk_rows=chunk_rows)
    assert filled.columns == df.columns
    assert {r["reading_id"]: r["value"] for r in filled.collect()} == brute_fill(data)


def test_rows_that_all_share_one_timestamp_are_cut_by_the_tie_break(spark):
    data = [(0, START, i, None if i % 3 else float(i)) for i in range(-200, 200)]
    filled = forward_fill(spark.createDataFrame(data, DDL), ["value"], ["meter_id"], tie="reading_id", chunk_rows=20)
    assert {r["reading_id"]: r["value"] for r in filled.collect()} == brute_fill(data)


def test_salted_join_gives_the_same(spark, monkeypatch):
    import wattline.storage as storage

    data = series(300)
    monkeypatch.setattr(storage.attach, "__defaults__", ((), None, -1))
    monkeypatch.setattr(ordered, "BROADCAST_BYTES", -1)
    filled = forward_fill(spark.createDataFrame(data, DDL), ["value"], ["meter_id"], tie="reading_id", chunk_rows=10)
    assert {r["reading_id"]: r["value"] for r in filled.collect()} == brute_fill(data)


def test_fill_does_not_depend_on_the_session_time_zone(utc):
    # around the hour that New York skips
    data = [(0, START.replace(month=3, day=10, hour=0) + timedelta(minutes=20 * i), i, float(i) if i % 4 == 0 else None) for i in range(30)]
    utc.conf.set("spark.sql.session.timeZone", "America/New_York")
    filled = forward_fill(utc.createDataFrame(data, DDL), ["value"], ["meter_id"], tie="reading_id", chunk_rows=3)
    assert {r["reading_id"]: r["value"] for r in filled.collect()} == brute_fill(data)


def test_fill_is_idempotent_and_keeps_leading_gaps(spark):
    df = spark.createDataFrame([(1, at(0), 0, None), (1, at(1), 1, 5.0), (1, at(2), 2, None)], DDL)
    once = forward_fill(df, ["value"], ["meter_id"])
    twice = forward_fill(once, ["value"], ["meter_id"])
    assert [r["value"] for r in once.orderBy("timestamp").collect()] == [None, 5.0, 5.0]
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_wide_equals_long(spark):
    draw = random.Random(3)
    data = [(at(i * 40), *[None if draw.random() < 0.5 else float(i * 10 + m) for m in range(3)]) for i in range(200)]
    wide = spark.createDataFrame(data, "timestamp timestamp_ntz, MT_001 double, MT_002 double, MT_003 double")
    meters = ["MT_001", "MT_002", "MT_003"]
    one = to_long(forward_fill(wide, meters, chunk_days=2, chunk_rows=30))
    two = forward_fill(to_long(wide), ["value"], ["meter_id"], chunk_rows=11)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.select(one.columns).collect()))


def test_large_chunk_tables_are_scanned_in_blocks(spark, monkeypatch):
    import wattline.operators.ordered as ordered

    draw = random.Random(4)
    data = [(at(i // 2 * 7), i, *[float(i) if draw.random() < 0.05 else None for _ in range(2)]) for i in range(600)]
    df = spark.createDataFrame(data, "timestamp timestamp_ntz, reading_id bigint, MT_001 double, MT_002 double")
    specs = [Near("left", F.col("MT_001")), Near("right", F.col("MT_002"), after=True, strict=True)]
    plain = nearest(df, specs, tie="reading_id", chunk_rows=5)
    monkeypatch.setattr(ordered, "CARRY_CELLS", 0)
    monkeypatch.setattr(ordered, "_BLOCKS", 8)
    blocked = nearest(df, specs, tie="reading_id", chunk_rows=5)
    assert sorted(map(str, blocked.collect())) == sorted(map(str, plain.collect()))
    last, want = None, {}
    for _, i, left, _ in data:
        last = left if left is not None else last
        want[i] = last
    assert {r["reading_id"]: r["left"] for r in blocked.collect()} == want


def test_strict_and_backward_looks(spark):
    data = [(1, at(i), i, v) for i, v in enumerate([None, 1.0, None, 3.0, None])]
    specs = [
        Near("before", F.col("value"), strict=True),
        Near("after", F.col("value"), after=True),
        Near("next", F.col("timestamp"), after=True, strict=True),
    ]
    got = nearest(spark.createDataFrame(data, DDL), specs, ["meter_id"], chunk_rows=2).orderBy("timestamp").collect()
    assert [r["before"] for r in got] == [None, None, 1.0, 1.0, 3.0]
    assert [r["after"] for r in got] == [1.0, 1.0, 3.0, 3.0, None]
    assert [r["next"] for r in got] == [at(1), at(2), at(3), at(4), None]


def test_a_null_key_is_a_series_of_its_own(spark):
    data = [(None, at(0), 0, 7.0), (None, at(96 * 60), 1, None), (1, at(0), 2, None)]
    filled = forward_fill(spark.createDataFrame(data, DDL), ["value"], ["meter_id"])
    assert {r["reading_id"]: r["value"] for r in filled.collect()} == {0: 7.0, 1: 7.0, 2: None}


def test_empty_input(spark):
    assert forward_fill(spark.createDataFrame([], DDL), ["value"], ["meter_id"]).count() == 0


def test_tie_break_must_be_an_integer(spark):
    df = spark.createDataFrame([], "timestamp timestamp_ntz, note string, value double")
    with pytest.raises(OptionError):
        forward_fill(df, ["value"], tie="note")


def test_plan_shuffles_rows_once_and_never_into_one_partition(spark):
    df = spark.createDataFrame(series(100), DDL)
    long = plan_of(forward_fill(df, ["value"], ["meter_id"]))
    assert "SinglePartition" not in long
    assert "Python" not in long
    # the rows, and the chunk table
    assert long.count("Exchange hashpartitioning") == 2


def test_shuffled_carry_moves_rows_once(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BROADCAST_BYTES", -1)
    df = spark.createDataFrame(series(100), DDL)
    monkeypatch.setattr("wattline.operators.ordered.CHUNK_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(forward_fill(df, ["value"], ["meter_id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the rows, the carried values, and the chunk table; the window finds the rows where the join put them
    assert plan.count("Exchange hashpartitioning") == 3 and "SortMergeJoin" in plan
