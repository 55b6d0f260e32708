"""Timings on made tables larger than the test data: many meters, and one hot meter.

Usage: python bench_scale.py [days] [long_rows]
Not a registered query: it shows how fill, row sum and medians behave as data and skew grow.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wattline.operators.clean import to_long
from wattline.operators.features import engineer_wide, total_by_time
from wattline.operators.impute import forward_fill
from wattline.operators.quantile import exact_median
from wattline.operators.contracts import RAW, Contract
from wattline.plans.prepare import PrepareOptions, gated, prepare
from wattline.sources.delimited import scan_delimited, write_delimited
from wattline.storage import materialize, scratch_path

METERS = 370


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def wide_table(spark: SparkSession, rows: int):
    """One row per quarter hour; about a tenth of the cells missing."""
    def cell(i: int):
        present = F.pmod(F.xxhash64("id", F.lit(i)), F.lit(10)) > 0
        return F.when(present, F.pmod(F.xxhash64("id", F.lit(-i)), F.lit(100_000)) / 100.0).alias(f"MT_{i:03d}")

    start = F.lit("2011-01-01 00:15:00").cast("timestamp_ntz")
    stamp = start + F.make_dt_interval(mins=(F.col("id") * 15).cast("int"))
    return spark.range(rows).select(stamp.alias("timestamp"), *[cell(i) for i in range(1, METERS + 1)])


def long_table(spark: SparkSession, rows: int, hot_share: float):
    """Readings of 10,000 meters in random order of time; one meter holds ``hot_share`` of all rows."""
    draw = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000)) / 1_000_000
    meter = F.when(draw < hot_share, F.lit(0)).otherwise(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10_000)))
    second = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(86_400 * 365))
    stamp = F.lit("2013-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=second)
    value = F.when(F.col("id") % 5 > 0, F.pmod(F.xxhash64("id", F.lit(4)), F.lit(1_000_000)) / 100.0)
    return spark.range(rows).select(meter.alias("meter_id"), stamp.alias("timestamp"), F.col("id").alias("reading_id"), value.alias("value"))


def main() -> None:
    days = int(sys.argv[1]) if len(sys.argv) > 1 else 1461
    rows = int(sys.argv[2]) if len(sys.argv) > 2 else 20_000_000
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, build) -> None:
        begin = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 2)
        print(name, times[name], file=sys.stderr, flush=True)

    wide = materialize(wide_table(spark, days * 96), "bench-wide")
    only = set(os.environ.get("BENCH_ONLY", "").split(",")) - {""}
    jobs = {
        "row_sum_wide": lambda: engineer_wide(wide),
        "row_sum_long": lambda: total_by_time(to_long(wide)),
        "fill_long_370": lambda: forward_fill(to_long(wide), ["value"], ["meter_id"]),
        "fill_wide_370": lambda: forward_fill(wide, [c for c in wide.columns if c != "timestamp"]),
        "prepare_long_370": lambda: prepare(wide, PrepareOptions(route="long")),
        "prepare_wide_370": lambda: prepare(wide, PrepareOptions(route="wide")),
    }
    for name, job in jobs.items():
        if not only or name in only:
            timed(name, job)
    if not only or "raw_text_to_features" in only:
        # the whole path of a raw file: scan, gates, coercion, scaling, fill, features
        texts = [F.translate(F.col(c).cast("string"), ".", ",").alias(c) for c in wide.columns[1:]]
        raw = wide.select(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("stamp"), *texts)
        path = write_delimited(raw.toDF("", *wide.columns[1:]), scratch_path(spark, "bench-raw"))
        timed("raw_text_to_features", lambda: gated(scan_delimited(spark, path, Contract(RAW))))
    if rows:
        even = materialize(long_table(spark, rows, 0.0), "bench-even")
        hot = materialize(long_table(spark, rows, 0.34), "bench-hot")
        for label, table in (("even", even), ("hot", hot)):
            for name, job in {
                f"fill_{label}": lambda t=table: forward_fill(t, ["value"], ["meter_id"], tie="reading_id"),
                f"fill_{label}_untied": lambda t=table: forward_fill(t, ["value"], ["meter_id"]),
                f"median_{label}": lambda t=table: exact_median(t, ["meter_id"], "value"),
            }.items():
                if not only or name in only:
                    timed(name, job)
    print(json.dumps({"days": days, "meters": METERS, "long_rows": rows, "seconds": times}))


if __name__ == "__main__":
    main()
