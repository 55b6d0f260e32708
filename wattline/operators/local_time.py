"""Local readings over the change of summer time.

A clock that goes back shows an hour twice, one that goes forward leaves an hour out. Readings are stamped with the local time; their order tells the two
passes of a repeated hour apart. Once every reading has its instant, a series is a plain grid again, and gaps are filled on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators.gaps import STEP_SECONDS, interpolate_gaps
from wattline.operators.ordered import CHUNK_DAYS, CHUNK_ROWS

#: Minutes by which clocks of the world go back.
_SHIFTS = (30, 60, 120)


def to_instant(ts: Column, zone: str) -> Column:
    """The UTC wall clock of a local time: of a repeated hour the first pass, of a skipped one as if the clock had not gone forward."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)


def to_local(instant: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), instant)


def resolve_local(
    df: DataFrame, zone: str, keys: Sequence[str] = ("meter_id",), ts: str = "timestamp", order: str = "reading_id"
) -> DataFrame:
    """``df`` with ``instant`` (UTC, without zone) and ``is_skipped`` (a local time that no clock of the zone showed).

    ``order`` tells in which order a series was read. In a repeated hour a reading belongs to the second pass if one before it has the same local time
    or a later one of that hour: the clock had gone back. Where the first pass lacks those readings, none shows that, and it counts as the first. Only readings of
    repeated hours are compared with others, within their series and day; a reading without timestamp has no instant.
    """
    first = to_instant(F.col(ts), zone)
    second = F.coalesce(*[F.when(to_local(first + F.expr(f"INTERVAL {m} MINUTES"), zone) == F.col(ts), first + F.expr(f"INTERVAL {m} MINUTES")) for m in _SHIFTS])
    placed = df.withColumn("_first", first).withColumn("_second", second)
    skipped = F.coalesce(to_local(F.col("_first"), zone) != F.col(ts), F.lit(False))
    before = Window.partitionBy(*keys, F.col(ts).cast("date")).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    repeated = placed.where("_second is not null")
    gone_back = F.coalesce(F.max(ts).over(before) >= F.col(ts), F.lit(False))
    told = repeated.select(*df.columns, F.when(gone_back, F.col("_second")).otherwise(F.col("_first")).alias("instant"), F.lit(False).alias("is_skipped"))
    return placed.where("_second is null").select(*df.columns, F.col("_first").alias("instant"), skipped.alias("is_skipped")).unionByName(told)


def interpolate_local(
    df: DataFrame, zone: str, value: str = "value", keys: Sequence[str] = ("meter_id",), ts: str = "timestamp", order: str = "reading_id",
    step_seconds: int = STEP_SECONDS, chunk_days: int = CHUNK_DAYS, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Complete the grid of every series in instants and fill missing values linearly, over both changes of the year.

    Readings of skipped local times are no readings and are left out (`resolve_local` shows them). Output: (keys, instant, local timestamp, value, is_filled);
    a repeated hour has both passes, a skipped one none.
    """
    resolved = resolve_local(df, zone, keys, ts, order).where(~F.col("is_skipped"))
    series = resolved.select(*keys, "instant", F.col(value).alias(value))
    grid = interpolate_gaps(series, value, keys, "instant", step_seconds, chunk_days, chunk_rows)
    return grid.select(*keys, "instant", to_local(F.col("instant"), zone).alias(ts), value, "is_filled")
