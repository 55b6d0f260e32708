"""Meter-like inputs derived from the ``events`` table, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.calendar import MICROS_PER_SECOND, slot_start, wall_micros
from wattline.operators.split import split_label
from wattline.plans.prepare import PrepareOptions, prepare

KINDS = ("click", "error", "purchase", "signup", "view")
METERS = tuple(f"MT_{i:03d}" for i in range(1, 6))
TRAIN_END, VAL_END, TEST_END = "2024-01-15", "2024-01-22", "2024-01-30"
# meter -> (period, text): every slot whose number is a multiple of the period holds that text.
TOKENS = {"MT_001": (17, "x"), "MT_002": (19, ""), "MT_003": (23, "1,234,5"), "MT_004": (29, "NaN"), "MT_005": (31, "1.5d")}
VARIANTS = {"low": 0.9, "mean": 1.0, "high": 1.1}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def exact_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute slots, one DECIMAL column per event type; missing where there was no event."""
    amount = F.col("value").cast("decimal(18,2)")
    sums = [
        F.sum(F.when(F.col("event_type") == kind, amount)).cast("decimal(18,2)").alias(meter)
        for meter, kind in zip(METERS, KINDS)
    ]
    return events(spark, sf_dir).groupBy(slot_start(F.col("ts")).alias("timestamp")).agg(*sums)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_readings(spark, sf_dir).select("timestamp", *[F.col(m).cast("double").alias(m) for m in METERS])


def readings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with decimal comma and some cells that are no numbers."""
    slot = F.floor(wall_micros(F.col("timestamp")) / (900 * MICROS_PER_SECOND))

    def cell(meter: str):
        period, token = TOKENS[meter]
        text = F.translate(F.col(meter).cast("string"), ".", ",")
        return F.when(slot % period == 0, F.lit(token)).otherwise(text).alias(meter)

    return exact_readings(spark, sf_dir).select("timestamp", *[cell(m) for m in METERS])


def raw_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As in a file: all text, the first column without a usable name."""
    raw = readings_raw(spark, sf_dir)
    stamp = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("Unnamed: 0")
    return raw.select(stamp, *METERS)


def readings_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per user; every third reading is missing."""
    kept = F.when(F.col("event_id") % 3 != 0, F.col("value"))
    return events(spark, sf_dir).select(
        F.col("ts").alias("timestamp"), F.col("user_id").alias("meter_id"), "event_id", kept.alias("value")
    )


def engineered(spark: SparkSession, sf_dir: str, route: str = "wide") -> DataFrame:
    return prepare(readings(spark, sf_dir), PrepareOptions(route=route))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation and test rows predicted by the train mean of their (hour, weekday), in three variants."""
    table = engineered(spark, sf_dir).withColumn("split", split_label(F.col("timestamp"), TRAIN_END, VAL_END))
    calendar = ["hour_of_day", "day_of_week"]
    # 24 x 7 rows at most, whatever the size of the table
    means = F.broadcast(table.where("split = 'train'").groupBy(*calendar).agg(F.avg("total_load").alias("mean_load")))
    rows = table.where("split <> 'train'").join(means, calendar)
    models = F.array(*[F.struct(F.lit(n).alias("model_name"), F.lit(f).alias("factor")) for n, f in VARIANTS.items()])
    return rows.select(
        "timestamp", "split", F.col("total_load").alias("label"), "mean_load", F.inline(models)
    ).select("timestamp", "split", "model_name", "label", (F.col("mean_load") * F.col("factor")).alias("prediction"))


def user_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user as model, and half of the month: MSE and RMSE of the values, from exact sums."""
    amount = F.col("value").cast("decimal(18,2)")
    square = (amount * amount).cast("decimal(28,4)")
    half = F.when(F.col("ts") < F.lit(TRAIN_END).cast("timestamp_ntz"), F.lit("baseline")).otherwise(F.lit("live"))
    per_user = events(spark, sf_dir).groupBy(F.col("user_id").alias("model_id"), half.alias("half")).agg(
        (F.sum(square).cast("double") / F.count(square)).alias("mse"), F.max("ts").alias("last_ts")
    )
    return per_user.withColumn("rmse", F.sqrt("mse"))


def user_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user with both halves side by side: baseline_* and live_*."""

    def pick(half: str, column: str):
        return F.max(F.when(F.col("half") == half, F.col(column))).alias(f"{half}_{column}")

    return user_metrics(spark, sf_dir).groupBy("model_id").agg(
        *[pick(h, c) for h in ("baseline", "live") for c in ("rmse", "mse")], F.max("last_ts").alias("last_ts")
    )


# --- SQL twins -------------------------------------------------------------------------------

_SUMS = ",\n  ".join(
    f"CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = '{k}') AS DECIMAL(18,2)) AS {m}"
    for m, k in zip(METERS, KINDS)
)
EXACT_SQL = f"""exact_readings AS (
  SELECT time_bucket(INTERVAL '15 minutes', ts) AS timestamp,
  {_SUMS}
  FROM events GROUP BY 1)"""
_DOUBLES = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in METERS)
READINGS_SQL = f"{EXACT_SQL},\nreadings AS (SELECT timestamp, {_DOUBLES} FROM exact_readings)"
_TEXTS = ",\n  ".join(
    f"CASE WHEN (epoch_us(timestamp) // 900000000) % {period} = 0 THEN '{token}' "
    f"ELSE replace(CAST({m} AS VARCHAR), '.', ',') END AS {m}"
    for m, (period, token) in TOKENS.items()
)
RAW_SQL = f"{EXACT_SQL},\nraw AS (SELECT timestamp,\n  {_TEXTS}\n  FROM exact_readings)"


def number_sql(cell: str) -> str:
    text = f"trim(replace({cell}, ',', '.'))"
    pattern = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)$"
    return f"CASE WHEN regexp_matches({text}, '{pattern}') THEN TRY_CAST({text} AS DOUBLE) END"


COERCED_SQL = f"{RAW_SQL},\ncoerced AS (SELECT timestamp, {', '.join(f'{number_sql(m)} AS {m}' for m in METERS)} FROM raw)"


def filled_sql(source: str, name: str = "filled", factor: float | None = 0.25, partition: str = "") -> str:
    scale = f" * {factor}" if factor is not None else ""
    by = f"PARTITION BY {partition} " if partition else ""
    cells = ", ".join(
        f"last_value({m}{scale} IGNORE NULLS) OVER ({by}ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS {m}"
        for m in METERS
    )
    extra = f"{partition}, " if partition else ""
    return f"{name} AS (SELECT {extra}timestamp, {cells} FROM {source})"


_C = [f"coalesce({m}, 0.0)" for m in METERS]
# the order in which the row sum adds, so that the last digit agrees
TOTAL_SQL = f"(({_C[0]} + {_C[1]}) + ({_C[2]} + {_C[3]})) + {_C[4]}"
CALENDAR_SQL = """CAST(hour(timestamp) AS BIGINT) AS hour_of_day,
  CAST(isodow(timestamp) - 1 AS BIGINT) AS day_of_week,
  CAST(isodow(timestamp) >= 6 AS BIGINT) AS is_weekend"""
ENGINEERED_SQL = f"""{READINGS_SQL},
{filled_sql('readings')},
engineered AS (SELECT timestamp, {TOTAL_SQL} AS total_load, {CALENDAR_SQL} FROM filled)"""
RAW_ENGINEERED_SQL = f"""{COERCED_SQL},
{filled_sql('coerced')},
engineered AS (SELECT timestamp, {TOTAL_SQL} AS total_load, {CALENDAR_SQL} FROM filled)"""
SPLIT_CASE_SQL = f"""CASE WHEN timestamp <= TIMESTAMP '{TRAIN_END}' THEN 'train'
  WHEN timestamp <= TIMESTAMP '{VAL_END}' THEN 'validation' ELSE 'test' END"""
_VARIANTS_SQL = ", ".join(f"{{'model_name': '{n}', 'factor': CAST({f} AS DOUBLE)}}" for n, f in VARIANTS.items())
PREDICTIONS_SQL = f"""{ENGINEERED_SQL},
labelled AS (SELECT *, {SPLIT_CASE_SQL} AS split FROM engineered),
means AS (SELECT hour_of_day, day_of_week, avg(total_load) AS mean_load FROM labelled WHERE split = 'train' GROUP BY ALL),
varied AS (SELECT timestamp, split, total_load, mean_load, unnest([{_VARIANTS_SQL}]) AS variant
  FROM labelled JOIN means USING (hour_of_day, day_of_week) WHERE split <> 'train'),
predictions AS (SELECT timestamp, split, variant.model_name AS model_name, total_load AS label,
  mean_load * variant.factor AS prediction FROM varied)"""
USER_METRICS_SQL = f"""user_metrics AS (
  SELECT user_id AS model_id, CASE WHEN ts < TIMESTAMP '{TRAIN_END}' THEN 'baseline' ELSE 'live' END AS half,
    CAST(sum(CAST(CAST(value AS DECIMAL(18,2)) * CAST(value AS DECIMAL(18,2)) AS DECIMAL(28,4))) AS DOUBLE) / count(value) AS mse,
    max(ts) AS last_ts,
    sqrt(mse) AS rmse
  FROM events GROUP BY ALL)"""
USER_HALVES_SQL = f"""{USER_METRICS_SQL},
user_halves AS (SELECT model_id,
  max(rmse) FILTER (WHERE half = 'baseline') AS baseline_rmse, max(mse) FILTER (WHERE half = 'baseline') AS baseline_mse,
  max(rmse) FILTER (WHERE half = 'live') AS live_rmse, max(mse) FILTER (WHERE half = 'live') AS live_mse,
  max(last_ts) AS last_ts FROM user_metrics GROUP BY model_id)"""
LONG_SQL = """readings_long AS (SELECT ts AS timestamp, user_id AS meter_id, event_id,
  CASE WHEN event_id % 3 <> 0 THEN value END AS value FROM events)"""


def elastic_net_sql(source: str, alpha: str = "0.1", ratio: str = "0.5", feature: str = "hour_of_day", name: str = "net") -> str:
    """Closed form for one feature: the soft-thresholded covariance over the ridged variance."""
    return f"""{name} AS (SELECT sign(c) * greatest(abs(c) - {alpha} * {ratio}, 0) / (v + {alpha} * (1 - {ratio})) AS w,
  my - w * mx AS b FROM (SELECT covar_pop(total_load, {feature}) AS c, var_pop({feature}) AS v,
    avg(total_load) AS my, avg({feature}) AS mx FROM {source}))"""
