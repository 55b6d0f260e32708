from datetime import timedelta

from pyspark.sql import functions as F

from helpers import START, at, rows
from test_ordered import DDL, brute_fill, series
from wattline.operators.models import ModelDefinition, fit, predict
from wattline.operators.features import engineer_wide
from wattline.operators.clean import coerce_numeric
from wattline.streaming.fill import StreamFill
from wattline.streaming.live import live_metrics, run_available, score_stream


def arrive(spark, data, path, fill):
    spark.createDataFrame(data, DDL).write.mode("append").parquet(path)
    query = fill.start(spark.readStream.schema(DDL).parquet(path))
    query.awaitTermination()


def test_fill_over_restarts_equals_batch(spark, tmp_path):
    data = sorted(series(240, seed=9), key=lambda r: (r[1], r[2]))
    fill = StreamFill(f"{tmp_path}/f", tie="reading_id", chunk_rows=15)
    cuts = [i for i in (80, 160, 240)]
    # cut where the timestamp changes, so that no reading is late
    begin = 0
    for cut in cuts:
        while cut < len(data) and data[cut][1] == data[cut - 1][1]:
            cut += 1
        arrive(spark, data[begin:cut], f"{tmp_path}/in", fill)
        begin = cut
    got = {r["reading_id"]: r["value"] for r in fill.result(spark).collect()}
    assert got == brute_fill(data)
    assert fill.late_rows(spark).isEmpty()


def test_late_readings_go_to_the_side_and_a_rerun_changes_nothing(spark, tmp_path):
    fill = StreamFill(f"{tmp_path}/f")
    arrive(spark, [(1, at(0), 0, 1.0), (1, at(5), 1, None), (2, at(9), 2, 4.0)], f"{tmp_path}/in", fill)
    second = [(1, at(3), 3, 9.0), (1, at(6), 4, None), (3, at(0), 5, None)]
    arrive(spark, second, f"{tmp_path}/in", fill)
    want = [(0, 1.0), (1, 1.0), (2, 4.0), (4, 1.0), (5, None)]
    assert rows(fill.result(spark).select("reading_id", "value"), "reading_id") == want
    assert rows(fill.late_rows(spark).select("reading_id")) == [(3,)]
    fill.process(spark.createDataFrame(second, DDL), 1)
    assert rows(fill.result(spark).select("reading_id", "value"), "reading_id") == want


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    data = [(at(i), f"{i},5", None if i % 3 else "x") for i in range(40)]
    raw = spark.createDataFrame(data, "timestamp timestamp_ntz, MT_001 string, MT_002 string")
    raw.write.parquet(f"{tmp_path}/in")
    batch = engineer_wide(coerce_numeric(raw, factor=0.25))
    model = fit(ModelDefinition("m", "elastic_net", {"alpha": 0.1}), batch, ["hour_of_day"])
    stream = spark.readStream.schema(raw.schema).parquet(f"{tmp_path}/in")
    run_available(score_stream(stream, model), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = rows(spark.read.parquet(f"{tmp_path}/out"), "timestamp")
    assert got == rows(predict(model, batch, ["timestamp"]), "timestamp")


def test_closed_windows_equal_batch(spark, tmp_path):
    data = [(START + timedelta(hours=h), float(h % 7), 3.0) for h in range(100)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, label double, prediction double")
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    run_available(live_metrics(stream, 1.8), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    whole = live_metrics(df, 1.8)
    # 100 hours: four whole days; the fifth window stays open
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "window_start") == rows(whole.where(F.col("n_rows") == 24), "window_start")
    assert whole.count() == 5


def test_batches_that_split_one_timestamp_equal_batch(spark, tmp_path):
    """Arrivals in order of (timestamp, tie), cut in the middle of a timestamp; a row behind the cut is late."""
    schema = "meter_id bigint, timestamp timestamp_ntz, n bigint, value double"
    data = [(1, at(0), 1, 7.0), (1, at(0), 5, 1.0), (1, at(0), 6, None), (1, at(0), 8, 9.0), (1, at(1), 9, None)]
    fill = StreamFill(f"{tmp_path}/fill", tie="n")
    for batch_id, part in enumerate((data[:2], data[2:3] + [(1, at(0), 3, None)], data[3:])):
        fill.process(spark.createDataFrame(part, schema), batch_id)
    got = {r["n"]: r["value"] for r in fill.result(spark).collect()}
    assert got == {1: 7.0, 5: 1.0, 6: 1.0, 8: 9.0, 9: 9.0}
    assert [r["n"] for r in fill.late_rows(spark).collect()] == [3]
    assert sorted(p.name for p in (tmp_path / "fill" / "state").iterdir() if p.is_dir()) == ["batch_id=1", "batch_id=2"]
