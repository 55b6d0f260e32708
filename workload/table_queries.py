"""Scans, contracts, cleaning, filling, features, split and profile queries."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.calendar import slot_start, wall_micros
from wattline.functions.names import matching
from wattline.functions.rowwise import row_aggregate
from wattline.operators.clean import KW_TO_KWH, coerce_numeric, scale_meters, select_meters
from wattline.operators.contracts import PREPROCESSED, RAW, Contract, conformance, quarantine
from wattline.operators.features import (
    dropped_columns as dropped,
    engineer_wide,
    feature_projection as project_features,
    total_by_time,
    with_row_aggregate,
    with_time_features,
)
from wattline.operators.gaps import interpolate_gaps as fill_gaps
from wattline.operators.gaps import interval_anomalies as odd_steps
from wattline.operators.impute import fill_median, fill_mode, forward_fill
from wattline.operators.local_time import interpolate_local, to_local
from wattline.operators.clean import to_long
from wattline.operators.profile import clean_checks as check_cleaned
from wattline.operators.profile import decimal_format as format_of
from wattline.operators.profile import first_rows, profile_columns as profile, total_load_check as compare_totals
from wattline.operators.split import features_only, time_split as split_by_time
from wattline.plans.monitor import live_slice as slice_live
from wattline.plans.prepare import PrepareOptions, gated, prepare, rejected_rows as rejected
from wattline.sources.delimited import (
    ingest_timestamp as ingest,
    normalize_header as clean_header,
    scan_delimited as scan_file,
    scan_directory,
    scan_headerless as scan_without_header,
    write_delimited,
)
from wattline.sources.tables import publish, read_published, save_engineered, vacuum
from wattline.storage import materialize, scratch_path
from workload import fixtures as fx
from workload.registry import query

_METERS = ", ".join(fx.METERS)


def _ends(df: DataFrame) -> DataFrame:
    """Total rounded, so that the order of summation does not show."""
    return df.withColumn("total_load", F.round("total_load", 6))


# --- scans -----------------------------------------------------------------------------------


def raw_file(spark: SparkSession, sf_dir: str) -> str:
    """The raw table as a ``;`` file with a blank first header."""
    rows = fx.raw_file_rows(spark, sf_dir)
    return write_delimited(rows.toDF("", *fx.METERS), scratch_path(spark, "raw-file"))


@query(f"WITH {fx.RAW_SQL} SELECT timestamp, {', '.join(f'''nullif({m}, '') AS {m}''' for m in fx.METERS)} FROM raw")
def scan_delimited(spark, sf_dir):
    # delimited text does not tell an empty cell from a missing one
    raw = scan_file(spark, raw_file(spark, sf_dir), Contract(RAW, "raw"))
    return ingest(raw).select("timestamp", *[F.nullif(F.col(m), F.lit("")).alias(m) for m in fx.METERS])


@query(
    f"WITH {fx.RAW_SQL} "
    + " UNION ALL ".join(
        [
            "SELECT 'Unnamed: 0' AS \"column\", 'object' AS type, count(timestamp) AS non_null FROM raw",
            *[f"SELECT '{m}', 'object', count({m}) FROM raw" for m in fx.METERS],
        ]
    )
)
def contract_expand(spark, sf_dir):
    lines = conformance(fx.raw_file_rows(spark, sf_dir), Contract(RAW, "raw"))
    return lines.select("column", F.col("expected").alias("type"), F.col("cells").alias("non_null"))


@query(
    f"""WITH {fx.RAW_SQL}, texts AS (SELECT CAST(timestamp AS VARCHAR) AS timestamp, {_METERS} FROM raw)
    SELECT 'preprocessed' AS contract, 'timestamp' AS "column", 'datetime64[us]' AS expected, 'object' AS actual,
      'type' AS kind, count(timestamp) AS cells, count(timestamp) - count(TRY_CAST(timestamp AS TIMESTAMP)) AS bad_cells FROM texts
    UNION ALL SELECT 'preprocessed', 'checked_at', 'datetime64[us]', NULL, 'missing', 0, 0
    """
    + "".join(
        f" UNION ALL SELECT 'preprocessed', '{m}', 'float64', 'object', 'type', count({m}), count({m}) - count({fx.number_sql(m)}) FROM texts"
        for m in fx.METERS
    )
)
def contract_violations(spark, sf_dir):
    texts = fx.raw_file_rows(spark, sf_dir).withColumnRenamed("Unnamed: 0", "timestamp")
    items = [*PREPROCESSED, {"column": "checked_at", "type": "datetime64[us]"}]
    return conformance(texts, Contract(items, "preprocessed")).where("kind <> 'ok'")


_STAMPS = "CASE WHEN event_id % 50 = 0 THEN 'n/a' WHEN event_id % 50 = 1 THEN NULL ELSE CAST(ts AS VARCHAR) END"


@query(f"SELECT TRY_CAST({_STAMPS} AS TIMESTAMP) AS timestamp, event_id, value FROM events")
def ingest_timestamp(spark, sf_dir):
    text = F.when(F.col("event_id") % 50 == 0, "n/a").when(F.col("event_id") % 50 != 1, F.col("ts").cast("string"))
    stamped = fx.events(spark, sf_dir).select(text.alias("recorded"), "event_id", "value")
    return ingest(stamped, strict=False)


@query(
    f"""WITH {fx.COERCED_SQL} SELECT CASE WHEN timestamp < TIMESTAMP '{fx.TRAIN_END}' THEN 'txt' ELSE 'csv' END AS ending,
    timestamp, {_METERS} FROM coerced"""
)
def scan_multi(spark, sf_dir):
    """Two kinds of files in one directory, the second with its columns in another order."""
    folder = reading_files(spark, sf_dir)
    scanned = clean_header(scan_directory(spark, folder).withColumnRenamed("Unnamed: 0", ""))
    ending = F.regexp_extract("source_file", r"\.(\w+)$", 1).alias("ending")
    return coerce_numeric(scanned, fx.METERS).select(ending, "timestamp", *fx.METERS)


def reading_files(spark, sf_dir) -> str:
    rows = fx.raw_file_rows(spark, sf_dir)
    early = F.col("Unnamed: 0") < F.lit(fx.TRAIN_END)
    folder = scratch_path(spark, "reading-files")
    for part, ending, order in ((rows.where(early), "txt", fx.METERS), (rows.where(~early), "csv", fx.METERS[::-1])):
        writer = part.select("Unnamed: 0", *order).toDF("", *order).write.mode("append")
        writer.option("header", True).option("sep", ";").option("extension", ending).csv(folder)
    return folder


@query(f"WITH {fx.COERCED_SQL} SELECT timestamp, {_METERS} FROM coerced")
def coerce_numeric_cells(spark, sf_dir):
    return coerce_numeric(fx.readings_raw(spark, sf_dir))


@query(f"WITH {fx.RAW_SQL} SELECT timestamp, {_METERS} FROM raw")
def normalize_header(spark, sf_dir):
    rows = fx.raw_file_rows(spark, sf_dir)
    return clean_header(rows.toDF("Unnamed: 0", *[f'"{m}"' for m in fx.METERS]))


@query(f"WITH {fx.COERCED_SQL} SELECT timestamp, {', '.join(f'{m} AS client_{i}' for i, m in enumerate(fx.METERS, 1))} FROM coerced")
def scan_headerless(spark, sf_dir):
    return scan_without_header(spark, raw_file(spark, sf_dir))


# --- sinks -----------------------------------------------------------------------------------


@query(
    " UNION ALL ".join(
        f"SELECT '{fmt}' AS format, * FROM (WITH {fx.ENGINEERED_SQL} SELECT timestamp, round(total_load, 6) AS total_load, "
        "hour_of_day, day_of_week, is_weekend FROM engineered)"
        for fmt in ("parquet", "csv")
    )
)
def sink_roundtrip(spark, sf_dir):
    table = fx.engineered(spark, sf_dir)
    stored = spark.read.schema(table.schema).parquet(save_engineered(table, scratch_path(spark, "engineered")))
    path = save_engineered(stored, scratch_path(spark, "engineered-csv"), "csv")
    text = (
        spark.read.schema(table.schema).option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    )
    both = stored.withColumn("format", F.lit("parquet")).unionByName(text.withColumn("format", F.lit("csv")))
    return _ends(both)


@query(f"WITH {fx.ENGINEERED_SQL} SELECT timestamp, round(total_load, 6) AS total_load, hour_of_day, day_of_week, is_weekend FROM engineered")
def publish_roundtrip(spark, sf_dir):
    """Published in two versions, with a job between them that fails; the second one is read, and the first is removed."""
    table = materialize(fx.engineered(spark, sf_dir), "engineered")
    path = scratch_path(spark, "published")
    publish(table.where("hour_of_day < 12"), path)
    try:
        publish(table.withColumn("total_load", F.raise_error(F.lit("stopped")).cast("double")), path)
    except PySparkException:
        pass
    publish(table, path)
    vacuum(spark, path)
    return read_published(spark, path, table.schema).withColumn("total_load", F.round("total_load", 6))


# --- projections and cleaning -----------------------------------------------------------------


@query(f"WITH {fx.READINGS_SQL} SELECT timestamp, {_METERS} FROM readings")
def select_meter_columns(spark, sf_dir):
    table = fx.readings(spark, sf_dir)
    return select_meters(table.withColumns({"MT_0011": F.lit(1.0), "XMT_001": F.lit(1.0), "note": F.lit("n")}))


@query(f"WITH {fx.READINGS_SQL} SELECT timestamp, {', '.join(f'{m} * 0.25 AS {m}' for m in fx.METERS)} FROM readings")
def scale_meter_columns(spark, sf_dir):
    return scale_meters(fx.readings(spark, sf_dir), KW_TO_KWH)


@query(
    f"WITH {fx.READINGS_SQL} SELECT timestamp, CAST(hour(timestamp) AS BIGINT) AS hour, round({fx.TOTAL_SQL}, 6) AS total_load FROM readings"
)
def feature_projection(spark, sf_dir):
    table = with_row_aggregate(fx.readings(spark, sf_dir)).withColumns(
        {"hour": F.hour("timestamp").cast("bigint"), "note": F.lit("text"), "is_early": F.hour("timestamp") < 6}
    )
    return _ends(project_features(table))


@query(f"WITH {fx.ENGINEERED_SQL} SELECT hour_of_day, day_of_week, is_weekend, count(*) AS n_rows FROM engineered GROUP BY ALL")
def xy_projection(spark, sf_dir):
    x = features_only(fx.engineered(spark, sf_dir))
    return x.groupBy(*x.columns).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    f"""WITH {fx.RAW_SQL}, checked AS (SELECT *, concat_ws(',', {', '.join(f"CASE WHEN {m} IS NOT NULL AND ({fx.number_sql(m)}) IS NULL THEN '{m}' END" for m in fx.METERS)}) AS bad FROM raw)
    SELECT bad AS bad_columns, count(*) AS n_rows FROM checked GROUP BY ALL"""
)
def quarantine_rows(spark, sf_dir):
    texts = fx.readings_raw(spark, sf_dir)
    good, bad = quarantine(texts, Contract(PREPROCESSED, "preprocessed"))
    reasons = bad.select(F.concat_ws(",", "bad_columns").alias("bad_columns"))
    both = good.select(F.lit("").alias("bad_columns")).unionAll(reasons)
    return both.groupBy("bad_columns").agg(F.count(F.lit(1)).alias("n_rows"))


# --- filling ---------------------------------------------------------------------------------


@query(f"WITH {fx.READINGS_SQL}, {fx.filled_sql('readings', factor=None)} SELECT timestamp, {_METERS} FROM filled")
def ffill_wide(spark, sf_dir):
    return forward_fill(fx.readings(spark, sf_dir), fx.METERS)


@query(
    f"""WITH {fx.LONG_SQL} SELECT meter_id, event_id, timestamp,
    last_value(value IGNORE NULLS) OVER (PARTITION BY meter_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING) AS value
    FROM readings_long"""
)
def ffill_long(spark, sf_dir):
    return forward_fill(fx.readings_long(spark, sf_dir), ["value"], ["meter_id"], tie="event_id")


@query(
    f"""WITH {fx.LONG_SQL} SELECT meter_id, event_id, round(coalesce(value, m), 6) AS value
    FROM readings_long JOIN (SELECT meter_id, median(value) AS m FROM readings_long GROUP BY 1) USING (meter_id)"""
)
def impute_median(spark, sf_dir):
    filled = fill_median(fx.readings_long(spark, sf_dir))
    return filled.select("meter_id", "event_id", F.round("value", 6).alias("value"))


@query(
    f"""WITH {fx.LONG_SQL}, counts AS (SELECT meter_id, value AS v, count(*) AS n FROM readings_long WHERE value IS NOT NULL GROUP BY ALL),
    modes AS (SELECT meter_id, v FROM counts QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY n DESC, v) = 1)
    SELECT meter_id, event_id, coalesce(value, v) AS value FROM readings_long LEFT JOIN modes USING (meter_id)"""
)
def impute_mode(spark, sf_dir):
    return fill_mode(fx.readings_long(spark, sf_dir)).select("meter_id", "event_id", "value")


@query(
    f"""WITH {fx.READINGS_SQL},
    cells AS (UNPIVOT (SELECT timestamp, {', '.join(f"coalesce({m}, 'nan') AS {m}" for m in fx.METERS)} FROM readings) ON {_METERS} INTO NAME meter_id VALUE value),
    present AS (SELECT timestamp, meter_id, CASE WHEN NOT isnan(value) THEN value END AS value FROM cells),
    steps AS (SELECT unnest(generate_series(min(timestamp), max(timestamp), INTERVAL '15 minutes')) AS timestamp FROM readings),
    grid AS (SELECT timestamp, meter_id, value FROM (SELECT steps.timestamp, m.meter_id FROM steps, (SELECT DISTINCT meter_id FROM present) m)
      LEFT JOIN present USING (timestamp, meter_id)),
    near AS (SELECT *,
      last_value(CASE WHEN value IS NOT NULL THEN timestamp END IGNORE NULLS) OVER before AS lt, last_value(value IGNORE NULLS) OVER before AS lv,
      first_value(CASE WHEN value IS NOT NULL THEN timestamp END IGNORE NULLS) OVER behind AS rt, first_value(value IGNORE NULLS) OVER behind AS rv
      FROM grid WINDOW before AS (PARTITION BY meter_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING),
        behind AS (PARTITION BY meter_id ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT meter_id, timestamp,
      coalesce(value, lv + (rv - lv) * (CAST(epoch_us(timestamp) - epoch_us(lt) AS DOUBLE) / (epoch_us(rt) - epoch_us(lt)))) AS value,
      value IS NULL AND lv IS NOT NULL AND rv IS NOT NULL AS is_filled FROM near"""
)
def interpolate_gaps(spark, sf_dir):
    return fill_gaps(to_long(fx.readings(spark, sf_dir)))


#: Days by which the slots are moved, so that clocks in Lisbon go back in them, on 27 October 2024 at 1:00 UTC.
_SHIFT_DAYS, _ZONE = 290, "Europe/Lisbon"


@query(
    f"""WITH slots AS (SELECT user_id % 3 AS meter_id, time_bucket(INTERVAL '15 minutes', ts) + INTERVAL {_SHIFT_DAYS} DAY AS moved, avg(value) AS value
      FROM events WHERE event_id % 5 <> 0 GROUP BY ALL),
    read_out AS (SELECT meter_id, epoch(moved)::BIGINT AS reading_id, moved + CASE WHEN moved < TIMESTAMP '2024-10-27 01:00:00' THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS t, value FROM slots),
    marked AS (SELECT *, t >= TIMESTAMP '2024-10-27 01:00:00' AND t < TIMESTAMP '2024-10-27 02:00:00' AS twice FROM read_out),
    passes AS (SELECT *, twice AND coalesce(max(t) OVER (PARTITION BY meter_id, twice ORDER BY reading_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= t, false) AS again FROM marked),
    told AS (SELECT meter_id, t - CASE WHEN t < TIMESTAMP '2024-10-27 01:00:00' OR (twice AND NOT again) THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS instant, avg(value) AS value
      FROM passes GROUP BY ALL),
    spans AS (SELECT meter_id, min(instant) AS a, max(instant) AS b FROM told GROUP BY 1),
    grid AS (SELECT meter_id, unnest(generate_series(a, b, INTERVAL '15 minutes')) AS instant FROM spans),
    near AS (SELECT g.meter_id, g.instant, value,
      last_value(CASE WHEN value IS NOT NULL THEN g.instant END IGNORE NULLS) OVER before AS lt, last_value(value IGNORE NULLS) OVER before AS lv,
      first_value(CASE WHEN value IS NOT NULL THEN g.instant END IGNORE NULLS) OVER behind AS rt, first_value(value IGNORE NULLS) OVER behind AS rv
      FROM grid g LEFT JOIN told USING (meter_id, instant) WINDOW before AS (PARTITION BY meter_id ORDER BY instant ROWS UNBOUNDED PRECEDING),
        behind AS (PARTITION BY meter_id ORDER BY instant ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT meter_id, instant, instant + CASE WHEN instant < TIMESTAMP '2024-10-27 01:00:00' THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS timestamp,
      round(coalesce(value, lv + (rv - lv) * (CAST(epoch_us(instant) - epoch_us(lt) AS DOUBLE) / (epoch_us(rt) - epoch_us(lt)))), 6) AS value, value IS NULL AS is_filled FROM near"""
)
def interpolate_local_time(spark, sf_dir):
    """Readings with local stamps over the hour that came twice: passes told apart by their order, gaps filled between instants."""
    moved = F.col("slot") + F.make_dt_interval(days=F.lit(_SHIFT_DAYS))
    slots = fx.events(spark, sf_dir).where("event_id % 5 <> 0").groupBy((F.col("user_id") % 3).alias("meter_id"), slot_start(F.col("ts")).alias("slot")).agg(F.avg("value").alias("value"))
    number = F.floor(wall_micros(F.col("moved")) / 1_000_000).cast("bigint").alias("reading_id")
    read_out = slots.withColumn("moved", moved).select("meter_id", number, to_local(F.col("moved"), _ZONE).alias("timestamp"), "value")
    filled = interpolate_local(read_out, _ZONE)
    return filled.withColumn("value", F.round("value", 6))


@query(
    f"""WITH {fx.READINGS_SQL}, steps AS (SELECT lag(timestamp) OVER (ORDER BY timestamp) AS previous, timestamp FROM readings)
    SELECT previous, timestamp, (epoch_us(timestamp) - epoch_us(previous)) / 900000000 AS steps FROM steps
    WHERE epoch_us(timestamp) - epoch_us(previous) <> 900000000"""
)
def interval_anomalies(spark, sf_dir):
    return odd_steps(fx.readings(spark, sf_dir))


# --- features --------------------------------------------------------------------------------

_ENGINEERED_OUT = "SELECT timestamp, round(total_load, 6) AS total_load, hour_of_day, day_of_week, is_weekend FROM engineered"


@query(f"WITH {fx.RAW_ENGINEERED_SQL} {_ENGINEERED_OUT}")
def engineered_readings(spark, sf_dir):
    """Flagship: raw text through all gates to the engineered table, by way of long form."""
    return _ends(gated(fx.raw_file_rows(spark, sf_dir)))


@query(f"WITH {fx.RAW_ENGINEERED_SQL} {_ENGINEERED_OUT}")
def engineered_readings_wide(spark, sf_dir):
    return _ends(prepare(fx.readings_raw(spark, sf_dir), PrepareOptions(route="wide")))


@query(f"WITH {fx.READINGS_SQL} SELECT timestamp, round({fx.TOTAL_SQL}, 6) AS total_load FROM readings")
def total_load(spark, sf_dir):
    return _ends(total_by_time(to_long(fx.readings(spark, sf_dir))))


_PRESENT = " + ".join(f"CAST({m} IS NOT NULL AS BIGINT)" for m in fx.METERS)


@query(
    f"""WITH {fx.READINGS_SQL} SELECT timestamp, round({fx.TOTAL_SQL}, 6) AS load_sum,
    round(({fx.TOTAL_SQL}) / nullif({_PRESENT}, 0), 6) AS load_mean,
    least({_METERS}) AS load_min, greatest({_METERS}) AS load_max FROM readings"""
)
def row_aggregates(spark, sf_dir):
    table = fx.readings(spark, sf_dir)
    meters = matching(table)
    made = {m: row_aggregate(meters, m) for m in ("sum", "mean", "min", "max")}
    rounded = {m: F.round(c, 6) if m in ("sum", "mean") else c for m, c in made.items()}
    return table.select("timestamp", *[c.alias(f"load_{m}") for m, c in rounded.items()])


@query(f"SELECT event_id, timestamp, {fx.CALENDAR_SQL} FROM (SELECT event_id, ts AS timestamp FROM events)")
def time_features(spark, sf_dir):
    return with_time_features(fx.events(spark, sf_dir).select("event_id", F.col("ts").alias("timestamp")))


# --- split -----------------------------------------------------------------------------------


@query(
    f"""WITH {fx.ENGINEERED_SQL} SELECT {fx.SPLIT_CASE_SQL} AS split, count(*) AS n_rows, min(timestamp) AS first_ts,
    max(timestamp) AS last_ts, round(sum(total_load), 6) AS load FROM engineered GROUP BY 1"""
)
def time_split(spark, sf_dir):
    parts = split_by_time(fx.engineered(spark, sf_dir), fx.TRAIN_END, fx.VAL_END)
    return parts.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.round(F.sum("total_load"), 6).alias("load"),
    )


@query(
    f"""WITH {fx.ENGINEERED_SQL} {_ENGINEERED_OUT}
    WHERE timestamp > TIMESTAMP '{fx.VAL_END}' AND timestamp <= TIMESTAMP '{fx.TEST_END}'"""
)
def live_slice(spark, sf_dir):
    return _ends(slice_live(fx.engineered(spark, sf_dir), fx.VAL_END, fx.TEST_END))


# --- profile ---------------------------------------------------------------------------------


@query(
    f"WITH {fx.READINGS_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) AS n_rows, count({c}) AS non_null, count(*) - count({c}) AS nulls FROM readings"""
        for c, t in [("timestamp", "datetime64[us]"), *[(m, "float64") for m in fx.METERS]]
    )
)
def profile_columns(spark, sf_dir):
    return profile(fx.readings(spark, sf_dir))


_FORMAT_COLUMNS = {
    "MT_001": "replace(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '.', ',')",
    "MT_002": "CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)",
    "MT_003": "CAST(event_id AS VARCHAR)",
    "MT_004": "'0.00'",
}


@query(
    f"WITH texts AS (SELECT {', '.join(f'{e} AS {m}' for m, e in _FORMAT_COLUMNS.items())} FROM events) "
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS "column", CASE WHEN bool_or(contains({m}, ',')) THEN 'comma'
        WHEN bool_and(coalesce(TRY_CAST({m} AS DOUBLE) = 0, false)) THEN 'zeros'
        WHEN bool_and(regexp_matches({m}, '^\\d+$')) THEN 'whole' ELSE 'no_comma' END AS decimal_format FROM texts"""
        for m in _FORMAT_COLUMNS
    )
)
def decimal_format(spark, sf_dir):
    amount = F.col("value").cast("decimal(18,2)").cast("string")
    texts = fx.events(spark, sf_dir).select(
        F.translate(amount, ".", ",").alias("MT_001"),
        amount.alias("MT_002"),
        F.col("event_id").cast("string").alias("MT_003"),
        F.lit("0.00").alias("MT_004"),
    )
    return format_of(texts)


@query(
    f"WITH {fx.RAW_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS "column", bool_or(({fx.number_sql(m)}) IS NULL) AS has_missing,
        count(*) FILTER (WHERE ({fx.number_sql(m)}) = 0) AS zeros,
        count(*) FILTER (WHERE ({fx.number_sql(m)}) = 0) > 0 AND NOT bool_and(contains(coalesce({m}, 'nan'), '0')) AS unexpected_zeros,
        count(*) FILTER (WHERE {m} IS NOT NULL AND ({fx.number_sql(m)}) IS NULL) AS lost_cells FROM raw"""
        for m in fx.METERS
    )
)
def clean_checks(spark, sf_dir):
    raw = fx.readings_raw(spark, sf_dir)
    copies = raw.select("timestamp", *fx.METERS, *[F.col(m).alias(f"clean_{m}") for m in fx.METERS])
    both = coerce_numeric(copies, [f"clean_{m}" for m in fx.METERS])
    return check_cleaned(both, {m: (m, f"clean_{m}") for m in fx.METERS})


@query(f"WITH {fx.READINGS_SQL} SELECT count(*) AS timestamps, true AS equal FROM readings")
def total_load_check(spark, sf_dir):
    options = PrepareOptions(route="wide")
    table = fx.readings(spark, sf_dir)
    wide = prepare(table, options)
    long = prepare(table, PrepareOptions(route="long"))
    same = (F.col("max_abs_diff") < 1e-6) & (F.col("row_difference") == 0)
    return compare_totals(wide, long).select("timestamps", same.alias("equal"))


_TWICE = ", ".join(f"{m} * 3 AS {m}" for m in fx.METERS)


def _repeated(spark, sf_dir):
    """Every reading and, under the same timestamp, one of three times its values."""
    table = fx.readings(spark, sf_dir)
    return table.unionByName(table.select("timestamp", *[(F.col(m) * 3).alias(m) for m in fx.METERS]))


@query(
    f"""WITH {fx.READINGS_SQL}, repeated AS (SELECT * FROM readings UNION ALL SELECT timestamp, {_TWICE} FROM readings),
    scaled AS (SELECT timestamp, {', '.join(f'{m} * 0.25 AS {m}' for m in fx.METERS)} FROM repeated)
    SELECT timestamp, round({fx.TOTAL_SQL}, 6) AS total_load FROM scaled"""
)
def repeated_timestamps(spark, sf_dir):
    """Rows that share a timestamp stay apart on the long route."""
    return _ends(prepare(_repeated(spark, sf_dir), PrepareOptions(imputation="none"))).select("timestamp", "total_load")


_UNTIMED = "(epoch_us(timestamp) // 900000000) % 50 = 0"


@query(
    f"""WITH {fx.READINGS_SQL} SELECT count(*) FILTER (WHERE NOT {_UNTIMED}) AS kept, count(*) FILTER (WHERE {_UNTIMED}) AS rejected, count(*) AS total
    FROM readings"""
)
def rejected_rows(spark, sf_dir):
    """Rows without timestamp are listed; with the kept ones they are the input."""
    slot = F.floor(wall_micros(F.col("timestamp")) / 900_000_000)
    table = fx.readings(spark, sf_dir).withColumn("timestamp", F.when(slot % 50 != 0, F.col("timestamp")))
    kept = prepare(table, PrepareOptions(untimed="reject", imputation="none")).select(F.lit("kept").alias("kind"))
    both = kept.unionAll(rejected(table).select(F.lit("rejected").alias("kind")))
    return both.agg(
        F.count_if(F.col("kind") == "kept").alias("kept"), F.count_if(F.col("kind") == "rejected").alias("rejected"), F.count(F.lit(1)).alias("total")
    )


@query(f"WITH {fx.ENGINEERED_SQL} {_ENGINEERED_OUT} ORDER BY timestamp LIMIT 5")
def time_feature_sample(spark, sf_dir):
    return _ends(first_rows(fx.engineered(spark, sf_dir)))


@query(
    f"WITH {fx.READINGS_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS "column", count({m}) AS values_dropped FROM readings""" for m in (*fx.METERS,)
    )
    + """ UNION ALL SELECT 'note', count(*) FROM readings"""
)
def dropped_columns(spark, sf_dir):
    table = fx.readings(spark, sf_dir).withColumn("note", F.date_format("timestamp", "yyyy"))
    lost = dropped(table, engineer_wide(table))
    counts = profile(table.select(*lost))
    return counts.select("column", F.col("non_null").alias("values_dropped"))
