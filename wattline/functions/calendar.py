"""Calendar columns and time-zone free arithmetic on timestamps."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND
_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def day_of_week(ts: Column) -> Column:
    """Monday is 0, Sunday is 6."""
    return F.weekday(ts).cast("bigint")


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("bigint")


# Feature name -> expression; the order is the column order of the engineered table.
TIME_FEATURES = {
    "hour_of_day": hour_of_day,
    "day_of_week": day_of_week,
    "is_weekend": is_weekend,
}


def wall_micros(ts: Column) -> Column:
    """Microseconds since 1970 on the wall clock.

    ``unix_micros`` goes through the session time zone, where the hour of a daylight-saving
    jump is not monotone; it is used in a UTC session only, where it costs nothing. The
    other form is right in every zone.
    """
    session = SparkSession.getActiveSession()
    if session is not None and session.conf.get("spark.sql.session.timeZone") in _UTC_NAMES:
        return F.unix_micros(ts.cast("timestamp"))
    seconds = F.hour(ts).cast("bigint") * 3600 + F.minute(ts) * 60
    fraction = (F.extract(F.lit("SECOND"), ts) * MICROS_PER_SECOND).cast("bigint")
    return F.unix_date(ts.cast("date")) * F.lit(MICROS_PER_DAY) + seconds * MICROS_PER_SECOND + fraction


def from_wall_micros(micros: Column) -> Column:
    """The zone-free timestamp of :func:`wall_micros`."""
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=micros / F.lit(Decimal(MICROS_PER_SECOND)))


def slot_start(ts: Column, step: str = "15 minutes") -> Column:
    """Start of the fixed-width time slot that holds ``ts``."""
    return F.window(ts, step)["start"]
