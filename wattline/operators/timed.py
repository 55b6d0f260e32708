"""Rows without a timestamp have no place in a series: they are refused, or left out and listed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.errors import OptionError


def rejected_rows(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Rows that have no place in time."""
    return df.where(F.col(ts).isNull())


def timed(df: DataFrame, untimed: str, ts: str = "timestamp") -> DataFrame:
    """Rows with a timestamp. Others "fail" the job that meets one, or are left out ("reject") and are those of `rejected_rows`."""
    if untimed == "reject":
        return df.where(F.col(ts).isNotNull())
    if untimed != "fail":
        raise OptionError(f"unknown choice {untimed!r} for rows without timestamp; known: fail, reject")
    refuse = F.raise_error(F.lit("a row has no timestamp; see rejected_rows")).cast("boolean")
    return df.where(F.when(F.col(ts).isNull(), refuse).otherwise(F.lit(True)))
