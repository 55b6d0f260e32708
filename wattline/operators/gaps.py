"""Checks and repairs on the time grid of a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.calendar import MICROS_PER_SECOND, wall_micros
from wattline.operators.ordered import CHUNK_DAYS, CHUNK_ROWS, Near, nearest
from wattline.operators.timed import timed

STEP_SECONDS = 900
_BLOCK = 4096


def interval_anomalies(
    df: DataFrame,
    ts: str = "timestamp",
    keys: Sequence[str] = (),
    tie: str | None = None,
    step_seconds: int = STEP_SECONDS,
    chunk_days: int = CHUNK_DAYS,
    chunk_rows: int = CHUNK_ROWS,
    untimed: str = "reject",
) -> DataFrame:
    """Rows that do not follow their predecessor by one step: (keys, previous, timestamp, steps).

    The first row of a series has no predecessor and is no anomaly. Rows without timestamp are left out, and are those of
    `rejected_rows`, or fail the job (``untimed`` "fail").
    """
    columns = [*keys, ts, *([tie] if tie else [])]
    stamped = timed(df, untimed, ts).select(*columns)
    before = Near("previous", F.col(ts), strict=True)
    steps = (wall_micros(F.col(ts)) - wall_micros(F.col("previous"))) / (step_seconds * MICROS_PER_SECOND)
    return (
        nearest(stamped, [before], keys, ts, tie, chunk_days, chunk_rows)
        .select(*keys, "previous", ts, steps.alias("steps"))
        .where(F.col("steps") != 1)
    )


def merge_repeated(df: DataFrame, value: str, keys: Sequence[str], ts: str = "timestamp") -> DataFrame:
    """Readings that share a timestamp (the repeated hour in autumn) become their mean."""
    return df.groupBy(*keys, ts).agg(F.avg(value).alias(value))


def interpolate_gaps(
    df: DataFrame,
    value: str = "value",
    keys: Sequence[str] = ("meter_id",),
    ts: str = "timestamp",
    step_seconds: int = STEP_SECONDS,
    chunk_days: int = CHUNK_DAYS,
    chunk_rows: int = CHUNK_ROWS,
    untimed: str = "reject",
) -> DataFrame:
    """Complete the grid of every series and fill missing values linearly in time.

    Missing steps are made from each reading and its follower, so no full grid is built
    and no join is needed. Nothing is filled before the first or after the last present value.
    Rows without timestamp are treated as in `interval_anomalies`. Output: (keys, timestamp, value, is_filled).
    """
    keys = list(keys)
    stamped = timed(df, untimed, ts).select(*keys, ts, F.col(value).cast("double").alias(value))
    merged = merge_repeated(stamped, value, keys, ts)
    known_at = F.when(F.col(value).isNotNull(), F.col(ts))
    seen = nearest(
        merged,
        [
            Near("_left_at", known_at),
            Near("_left", F.col(value)),
            Near("_right_at", known_at, after=True),
            Near("_right", F.col(value), after=True),
            Near("_next", F.col(ts), after=True, strict=True),
            Near("_beyond_at", known_at, after=True, strict=True),
            Near("_beyond", F.col(value), after=True, strict=True),
        ],
        keys,
        ts,
        None,
        chunk_days,
        chunk_rows,
    )
    # Steps 0 (the reading itself) to the last one before the next reading, made in blocks, so that a
    # silence of years is never one array.
    width = step_seconds * MICROS_PER_SECOND
    distance = wall_micros(F.col("_next")) - wall_micros(F.col(ts))
    last_step = F.coalesce(F.greatest(F.ceil(distance / width) - 1, F.lit(0)), F.lit(0)).cast("bigint")
    blocks = seen.withColumn("_last_step", last_step).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("_last_step") / _BLOCK).cast("bigint")))
    )
    first = F.col("_block") * _BLOCK
    steps = blocks.withColumn("_step", F.explode(F.sequence(first, F.least(F.col("_last_step"), first + (_BLOCK - 1)))))
    shift = F.make_dt_interval(secs=F.col("_step") * step_seconds)
    grid = steps.withColumn("_at", F.when(F.col("_step") == 0, F.col(ts)).otherwise(F.col(ts) + shift))

    is_reading = F.col("_step") == 0
    right_at = F.when(is_reading, F.col("_right_at")).otherwise(F.col("_beyond_at"))
    right = F.when(is_reading, F.col("_right")).otherwise(F.col("_beyond"))
    start = wall_micros(F.col("_left_at"))
    share = (wall_micros(F.col("_at")) - start) / (wall_micros(right_at) - start)
    present = is_reading & F.col(value).isNotNull()
    filled = F.when(present, F.col(value)).otherwise(F.col("_left") + (right - F.col("_left")) * share)
    return grid.select(
        *keys, F.col("_at").alias(ts), filled.alias(value), (~present & filled.isNotNull()).alias("is_filled")
    )
