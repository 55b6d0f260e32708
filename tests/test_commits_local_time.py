"""Commits of several writers, published tables, and readings over the change of summer time."""

import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import rows
from wattline.errors import OptionError
from wattline.operators.local_time import interpolate_local, resolve_local
from wattline.sources import commits, tables
from wattline.sources.commits import CommitLog, put_if_absent
from wattline.sources.tables import load_champion, publish, read_published, register, registry_records, vacuum

ZONE = "Europe/Lisbon"


def test_put_if_absent(spark, tmp_path):
    path = f"{tmp_path}/log/a b.json"
    assert put_if_absent(spark, path, "one") and not put_if_absent(spark, path, "two")
    assert open(path).read() == "one" and not [p for p in (tmp_path / "log").iterdir() if "draft" in p.name and not p.name.endswith(".crc")]


def test_writers_at_the_same_time_get_their_own_versions(spark, tmp_path, monkeypatch):
    path, gate = f"{tmp_path}/registry", threading.Barrier(4)
    plain = CommitLog.numbers

    def numbers(self):
        found = plain(self)
        gate.wait(60)  # all writers have read before one writes
        return found

    monkeypatch.setattr(CommitLog, "numbers", numbers)
    versions = []
    writers = [threading.Thread(target=lambda k=k: versions.append((register(spark, path, f"m{k}", "p", {"rmse": float(k)}, "now"), f"m{k}"))) for k in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    monkeypatch.setattr(CommitLog, "numbers", plain)
    assert sorted(v for v, _ in versions) == ["v1", "v2", "v3", "v4"]
    assert sorted((r.version, r.model_name) for r in registry_records(spark, path).collect()) == sorted(versions)
    champion = load_champion(spark, path)
    assert (champion["version"], champion["model_name"]) == max(versions) and champion["metrics"]["rmse"] == float(champion["model_name"][1])


def test_a_writer_that_stops_leaves_the_champion(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/registry"
    register(spark, path, "old", "p", {"rmse": 1.0}, "now")

    def stops(*given):
        raise RuntimeError("stopped")

    monkeypatch.setattr(commits, "put_if_absent", stops)
    with pytest.raises(RuntimeError):
        register(spark, path, "new", "p", {"rmse": 0.5}, "now")
    monkeypatch.undo()
    assert load_champion(spark, path)["model_name"] == "old"
    assert register(spark, path, "next", "p", {}, "now") == "v2"


def test_records_from_before_commits_count(spark, tmp_path):
    path = f"{tmp_path}/registry"
    old = [("v1", "a", "p", {}, "champion", "t"), ("v7", "b", "p", {}, "champion", "t")]
    tables.append_rows(spark, path, old, tables.REGISTRY_SCHEMA)
    assert load_champion(spark, path)["model_name"] == "b"
    assert register(spark, path, "c", "p", {"rmse": 2.0}, "t") == "v8" and load_champion(spark, path)["model_name"] == "c"
    assert registry_records(spark, path).count() == 3


def test_a_failed_job_leaves_the_published_table(spark, tmp_path):
    path = f"{tmp_path}/engineered"
    with pytest.raises(OptionError):
        read_published(spark, path)
    publish(spark.range(3), path)
    before = read_published(spark, path)
    failing = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        publish(failing, path)
    assert rows(read_published(spark, path), "id") == [(0,), (1,), (2,)]
    publish(spark.range(5), path, "csv")
    # who has opened the version before keeps it
    assert before.count() == 3 and read_published(spark, path).count() == 5
    vacuum(spark, path)
    assert len([p for p in (tmp_path / "engineered").iterdir() if p.name.startswith("version-")]) == 1 and read_published(spark, path).count() == 5


def stamps(day, *clock):
    return [datetime(*day, int(c[:-2]), int(c[-2:])) for c in clock]


def local_series(spark, times, values=None, meter=1):
    data = [(meter, t, k, float(k) if values is None else values[k]) for k, t in enumerate(times)]
    return spark.createDataFrame(data, "meter_id int, timestamp timestamp_ntz, reading_id long, value double")


def test_repeated_hour(spark, utc):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    # in Lisbon the clock went back from 2 to 1 on 28 October 2012, at 1:00 UTC
    times = stamps((2012, 10, 28), "0030", "0045", "0100", "0115", "0130", "0145", "0100", "0115", "0145", "0200")
    found = rows(resolve_local(local_series(spark, times), ZONE).select("reading_id", "instant", "is_skipped"), "reading_id")
    utc_times = [datetime(2012, 10, 27, 23, 30) + timedelta(minutes=15 * k) for k in range(8)] + [datetime(2012, 10, 28, 1, 45), datetime(2012, 10, 28, 2, 0)]
    assert found == [(k, t, False) for k, t in enumerate(utc_times)]
    grid = interpolate_local(local_series(spark, times), ZONE)
    got = rows(grid.select("instant", "timestamp", "value", "is_filled"), "instant")
    local = stamps((2012, 10, 28), "0030", "0045", "0100", "0115", "0130", "0145", "0100", "0115", "0130", "0145", "0200")
    assert [r[1] for r in got] == local and [r[2] for r in got] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 7.5, 8.0, 9.0]
    assert [r[3] for r in got] == [False] * 8 + [True] + [False] * 2


def test_skipped_hour(spark):
    # and forward from 1 to 2 on 25 March 2012; some meters write zeros for the hour that there was none
    times = stamps((2012, 3, 25), "0030", "0045", "0100", "0115", "0130", "0145", "0200", "0230")
    values = [1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 3.0, 5.0]
    resolved = resolve_local(local_series(spark, times, values), ZONE)
    assert rows(resolved.where("is_skipped").select("reading_id"), "reading_id") == [(2,), (3,), (4,), (5,)]
    got = rows(interpolate_local(local_series(spark, times, values), ZONE).select("instant", "timestamp", "value", "is_filled"), "instant")
    assert got == [
        (datetime(2012, 3, 25, 0, 30), datetime(2012, 3, 25, 0, 30), 1.0, False), (datetime(2012, 3, 25, 0, 45), datetime(2012, 3, 25, 0, 45), 2.0, False),
        (datetime(2012, 3, 25, 1, 0), datetime(2012, 3, 25, 2, 0), 3.0, False), (datetime(2012, 3, 25, 1, 15), datetime(2012, 3, 25, 2, 15), 4.0, True),
        (datetime(2012, 3, 25, 1, 30), datetime(2012, 3, 25, 2, 30), 5.0, False),
    ]


def test_half_hour_change_series_apart_and_missing_stamps(spark):
    # Lord Howe Island goes back by half an hour, from 2:00 to 1:30 on 7 April 2024
    times = stamps((2024, 4, 7), "0130", "0145", "0130", "0145", "0200")
    both = local_series(spark, times).unionByName(local_series(spark, [*times[:2], None], meter=2))
    found = rows(resolve_local(both, "Australia/Lord_Howe").select("meter_id", "reading_id", "instant"), "meter_id", "reading_id")
    start = datetime(2024, 4, 6, 14, 30)
    assert found == [(1, k, start + timedelta(minutes=15 * k)) for k in range(5)] + [(2, 0, start), (2, 1, start + timedelta(minutes=15)), (2, 2, None)]
