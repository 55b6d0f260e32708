import pytest

from helpers import at, rows
from wattline.operators.gaps import interpolate_gaps, interval_anomalies, merge_repeated

DDL = "meter_id int, timestamp timestamp_ntz, value double"


@pytest.mark.parametrize("chunk_rows", [1, 2_000_000])
def test_interpolation(spark, chunk_rows):
    data = [(1, at(0), None), (1, at(1), 10.0), (1, at(2), None), (1, at(5), 50.0), (1, at(6), None), (2, at(0), 1.0)]
    got = rows(interpolate_gaps(spark.createDataFrame(data, DDL), chunk_rows=chunk_rows), "meter_id", "timestamp")
    assert [(t, v, f) for m, t, v, f in got if m == 1] == [
        (at(0), None, False), (at(1), 10.0, False), (at(2), 20.0, True), (at(3), 30.0, True), (at(4), 40.0, True),
        (at(5), 50.0, False), (at(6), None, False),
    ]
    assert [g for g in got if g[0] == 2] == [(2, at(0), 1.0, False)]


def test_repeated_hour_becomes_its_mean(spark):
    data = [(1, at(0), 1.0), (1, at(0), 3.0), (1, at(0), None), (1, at(1), 5.0)]
    assert rows(merge_repeated(spark.createDataFrame(data, DDL), "value", ["meter_id"]), "timestamp") == [(1, at(0), 2.0), (1, at(1), 5.0)]
    assert [r[2] for r in rows(interpolate_gaps(spark.createDataFrame(data, DDL)), "timestamp")] == [2.0, 5.0]


def test_a_step_that_does_not_divide_the_gap_never_passes_the_next_reading(spark):
    data = [(1, at(0, 1), 0.0), (1, at(40, 1), 40.0)]
    got = rows(interpolate_gaps(spark.createDataFrame(data, DDL)), "timestamp")
    assert [(r[1], r[2]) for r in got] == [(at(m, 1), float(m)) for m in (0, 15, 30, 40)]


def test_a_long_silence_is_filled_in_blocks(spark):
    n = 10_000
    data = [(1, at(0), 0.0), (1, at(n), float(n))]
    got = interpolate_gaps(spark.createDataFrame(data, DDL)).selectExpr(
        "count(*)", "count(distinct timestamp)", "sum(value)", "count_if(is_filled)"
    )
    assert rows(got) == [(n + 1, n + 1, pytest.approx(n * (n + 1) / 2), n - 1)]


@pytest.mark.parametrize("chunk_rows", [1, 2_000_000])
def test_odd_intervals(spark, chunk_rows):
    data = [(at(i),) for i in (0, 1, 1, 4)] + [(None,)]
    df = spark.createDataFrame(data, "timestamp timestamp_ntz")
    got = rows(interval_anomalies(df, chunk_rows=chunk_rows), "timestamp")
    assert got == [(at(1), at(1), 0.0), (at(1), at(4), 3.0)]
