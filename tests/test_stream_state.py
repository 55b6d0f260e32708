"""Live metrics of all windows, and fills that late readings correct."""

import random
from datetime import timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import START, at, rows
from test_ordered import DDL, brute_fill, series
from wattline.operators.gaps import interpolate_gaps, interval_anomalies
from wattline.operators.timed import rejected_rows
from wattline.streaming.fill import StreamFill
from wattline.streaming.live import live_metrics
from wattline.streaming.metrics import LiveMetrics
from wattline.streaming.restate import RestatedFill

METRIC_DDL = "ts timestamp_ntz, label double, prediction double, site string"


def arrive(spark, data, ddl, path, job):
    spark.createDataFrame(data, ddl).write.mode("append").parquet(path)
    job.start(spark.readStream.schema(ddl).parquet(path)).awaitTermination()


def test_all_windows_and_late_rows_are_accounted_for(spark, tmp_path):
    draw = random.Random(3)
    data = [(START + timedelta(hours=h, minutes=draw.randint(0, 59)), float(h % 7), draw.choice([3.0, None]), draw.choice("xy")) for h in range(100)]
    parts = [data[:40], data[40:70] + [(None, 1.0, 1.0, "x")], [*data[70:], (START + timedelta(hours=1), 9.0, 0.0, "x"), (START + timedelta(hours=30), 9.0, 0.0, "y")]]
    job = LiveMetrics(f"{tmp_path}/m", 1.8, by=["site"])
    assert job.result(spark) is None
    for part in parts:
        arrive(spark, part, METRIC_DDL, f"{tmp_path}/in", job)
    late = rows(job.late_rows(spark).select("ts"), "ts")
    # the newest time is hour 69 when they come: the windows of the first two days have been closed for an hour and more
    assert late == [(START + timedelta(hours=1),), (START + timedelta(hours=30),)]
    assert job.untimed_rows(spark).count() == 1
    found = job.result(spark)
    assert found.agg(F.sum("n_rows")).first()[0] + len(late) + 1 == sum(map(len, parts))
    whole = live_metrics(spark.createDataFrame(data, METRIC_DDL), 1.8, by=["site"])
    columns = ["window_start", "site", "n_rows", F.round("mse", 9), F.round("rmse", 9), "drift_detected"]
    assert rows(found.select(*columns), "window_start", "site") == rows(whole.select(*columns), "window_start", "site")
    assert {r.window_start.day: r.is_final for r in found.collect()} == {1: True, 2: True, 3: True, 4: True, 5: False}
    # the last batch again changes nothing
    before = rows(found, "window_start", "site")
    job.process(spark.createDataFrame(parts[2], METRIC_DDL), 2)
    assert rows(job.result(spark), "window_start", "site") == before


def test_windows_without_usable_rows(spark, tmp_path):
    job = LiveMetrics(f"{tmp_path}/m", 1.0)
    job.process(spark.createDataFrame([(at(0), None, 1.0, "x")], METRIC_DDL), 0)
    job.process(spark.createDataFrame([], METRIC_DDL), 1)
    job.process(spark.createDataFrame([(at(1), 3.0, 1.0, "x")], METRIC_DDL), 2)
    assert [(r.n_rows, r.mse, r.is_final) for r in job.result(spark).collect()] == [(2, 4.0, False)]


@pytest.mark.parametrize("seed, chunk_rows", [(1, 15), (2, 2_000_000)])
def test_shuffled_arrival_equals_batch(spark, tmp_path, seed, chunk_rows):
    data = series(240, seed=seed)
    draw = random.Random(seed)
    span = (max(r[1] for r in data) - min(r[1] for r in data)).total_seconds()
    # readings come up to a tenth of the span late
    delayed = sorted((r[1] + timedelta(seconds=draw.random() * span / 10), k) for k, r in enumerate(data))
    order = [data[k] for _, k in delayed]
    job = RestatedFill(f"{tmp_path}/f", int(span / 10) + 1, tie="reading_id", chunk_rows=chunk_rows)
    for begin in range(0, 240, 48):
        arrive(spark, order[begin : begin + 48], DDL, f"{tmp_path}/in", job)
    got = {r["reading_id"]: r["value"] for r in job.result(spark).collect()}
    assert got == brute_fill(data)
    assert job.late_rows(spark).isEmpty() and not job.restated(spark).isEmpty()


def test_restated_fill_by_hand(spark, tmp_path):
    job = RestatedFill(f"{tmp_path}/f", 1800)
    first = [(1, at(0), 0, 1.0), (1, at(3), 1, None), (1, at(4), 2, None), (2, at(9), 3, None), (None, at(0), 4, 7.0)]
    second = [(1, at(2), 5, 9.0), (1, at(1), 6, 5.0), (1, None, 7, 1.0), (None, at(1), 8, None), (3, at(0), 9, None)]
    third = [(1, at(9), 10, None), (2, at(8), 11, 4.0), (2, at(6), 12, 8.0)]
    for number, part in enumerate((first, second, third)):
        job.process(spark.createDataFrame(part, DDL), number)
    got = {r.reading_id: r.value for r in job.result(spark).collect()}
    # meter 1: reading 5 lies within half an hour of the newest and corrects 1 and 2, reading 6 does not; meter 2: 11 corrects 3
    assert got == {0: 1.0, 1: 9.0, 2: 9.0, 3: 4.0, 4: 7.0, 5: 9.0, 8: 7.0, 9: None, 10: 9.0, 11: 4.0}
    assert sorted(r.reading_id for r in job.late_rows(spark).collect()) == [6, 12]
    assert [r.reading_id for r in job.untimed_rows(spark).collect()] == [7]
    before = rows(job.result(spark), "reading_id")
    job.process(spark.createDataFrame(third, DDL), 2)
    assert rows(job.result(spark), "reading_id") == before


def test_untimed_rows_are_listed_or_refused(spark, tmp_path):
    data = [(1, at(0), 0, 1.0), (1, None, 1, 2.0), (1, at(2), 2, None)]
    df = spark.createDataFrame(data, DDL)
    fill = StreamFill(f"{tmp_path}/f")
    fill.process(df, 0)
    assert fill.result(spark).count() + fill.untimed_rows(spark).count() + fill.late_rows(spark).count() == 3
    assert rejected_rows(df).count() == 1
    for job in (interval_anomalies, interpolate_gaps):
        assert job(df, keys=["meter_id"]).count() >= 1
        with pytest.raises(PySparkException, match="no timestamp"):
            job(df, keys=["meter_id"], untimed="fail").count()
