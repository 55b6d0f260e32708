"""Split by time into train, validation and test."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.errors import OptionError, WattlineError

# Default bounds. A bound is midnight at the start of its day, and is inclusive.
TRAIN_END = "2013-12-31"
VAL_END = "2014-06-30"


def day_bound(value: str | datetime) -> Column:
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def split_label(
    ts: Column, train_end: str = TRAIN_END, val_end: str = VAL_END, test_end: str | None = None
) -> Column:
    """'train', 'validation', 'test', or NULL for rows without timestamp or past ``test_end``."""
    past = ts > day_bound(val_end)
    if test_end is not None:
        past = past & (ts <= day_bound(test_end))
    return (
        F.when(ts <= day_bound(train_end), F.lit("train"))
        .when((ts > day_bound(train_end)) & (ts <= day_bound(val_end)), F.lit("validation"))
        .when(past, F.lit("test"))
    )


def _guard(df: DataFrame, ts: str) -> None:
    if ts not in df.columns:
        raise OptionError(f"no {ts!r} column to split on")


def time_split(
    df: DataFrame,
    train_end: str = TRAIN_END,
    val_end: str = VAL_END,
    test_end: str | None = None,
    ts: str = "timestamp",
) -> DataFrame:
    """Every row with its ``split``. No job and no shuffle."""
    _guard(df, ts)
    return df.withColumn("split", split_label(F.col(ts), train_end, val_end, test_end))


def split_frames(
    df: DataFrame,
    train_end: str = TRAIN_END,
    val_end: str = VAL_END,
    test_end: str | None = None,
    ts: str = "timestamp",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test as plain range filters, which reach a Parquet scan."""
    _guard(df, ts)
    if df.isEmpty():
        raise WattlineError("cannot split an empty table")
    at = F.col(ts)
    test = df.where(at > day_bound(val_end))
    if test_end is not None:
        test = test.where(at <= day_bound(test_end))
    return (
        df.where(at <= day_bound(train_end)),
        df.where((at > day_bound(train_end)) & (at <= day_bound(val_end))),
        test,
    )


def features_only(df: DataFrame, target: str = "total_load", ts: str = "timestamp") -> DataFrame:
    """The model input: no target, no timestamp."""
    return df.drop(target, ts)


def feature_columns(df: DataFrame, target: str = "total_load", ts: str = "timestamp") -> list[str]:
    return [c for c in df.columns if c not in (target, ts, "split", "source_file")]
