"""Filling of missing readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.errors import OptionError
from wattline.operators.clean import to_long
from wattline.operators.ordered import CHUNK_DAYS, CHUNK_ROWS, Near, nearest
from wattline.operators.quantile import HOT_ROWS, exact_median
from wattline.storage import attach, materialize


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    ts: str = "timestamp",
    tie: str | None = None,
    chunk_days: int = CHUNK_DAYS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Last present value at or before each row; leading gaps stay.

    Long tables pass the series columns as ``keys`` and one value column; wide
    tables pass no key (or the source file) and every meter column.
    """
    columns = list(columns)
    if not columns:
        return df
    specs = [Near(f"_fill{i}", F.col(c)) for i, c in enumerate(columns)]
    filled = nearest(df, specs, keys, ts, tie, chunk_days, chunk_rows)
    place = {c: i for i, c in enumerate(columns)}
    return filled.select(*[F.col(f"_fill{place[c]}").alias(c) if c in place else F.col(c) for c in df.columns])


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _fill_from(df: DataFrame, stats: DataFrame, value: str, key: str | Sequence[str], ts: str) -> DataFrame:
    # One row per series; the join is broadcast only when that table is within the bound.
    stats = materialize(stats.select(*_keys(key), F.col(value).alias("_stat")), "fill-values")
    joined = attach(df, stats, _keys(key), [ts])
    return joined.select(
        *[F.coalesce(F.col(c), F.col("_stat")).alias(c) if c == value else F.col(c) for c in df.columns]
    )


def fill_median(
    df: DataFrame, value: str = "value", key: str | Sequence[str] = "meter_id", ts: str = "timestamp", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Exact median of each series, missing values left out of it. ``key`` may be several columns, such as file and meter."""
    return _fill_from(df, exact_median(df, _keys(key), value, hot_rows), value, key, ts)


def mode_of(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent value per key; the smallest one on ties.

    Counting on (key, value) first keeps a hot key spread over all tasks.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(
        F.max_by(value, F.struct(F.col("_n"), (-F.col(value)).alias("_neg"))).alias(value)
    )


def fill_mode(df: DataFrame, value: str = "value", key: str | Sequence[str] = "meter_id", ts: str = "timestamp") -> DataFrame:
    return _fill_from(df, mode_of(df, _keys(key), value), value, key, ts)


def fill_wide(df: DataFrame, columns: Sequence[str], strategy: str, keys: Sequence[str] = ()) -> DataFrame:
    """Median or mode of every column, per ``keys``, for missing cells.

    The statistics are one row per (keys, column). Without keys they are as many as columns and become literals; with keys they
    meet the rows as one map per key.
    """
    columns = list(columns)
    long = to_long(df, columns, keys, meter="_place", named=False)
    make = {"median": lambda d, k: exact_median(d, k, "value"), "mode": lambda d, k: mode_of(d, k, "value")}
    if strategy not in make:
        raise OptionError(f"no wide form of strategy {strategy!r}; known: {sorted(make)}")
    stats = make[strategy](long, [*keys, "_place"])
    if not keys:
        known = {r["_place"]: r["value"] for r in stats.collect()}  # one row per column at most
        filled = {c: F.coalesce(F.col(c), F.lit(known.get(i))) for i, c in enumerate(columns)}
        return df.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])
    maps = stats.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_place", "value"))).alias("_stats"))
    joined = attach(df, materialize(maps, "fill-values"), keys, columns[:1])
    filled = {c: F.coalesce(F.col(c), F.col("_stats")[i]) for i, c in enumerate(columns)}
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


# Names of the strategies.
STRATEGIES = ("forward_fill", "median", "mode", "none")


def impute_long(
    df: DataFrame,
    strategy: str = "forward_fill",
    value: str = "value",
    key: str | Sequence[str] = "meter_id",
    ts: str = "timestamp",
    tie: str | None = None,
) -> DataFrame:
    """Fill a long table; an unknown strategy is an error, ``none`` leaves the gaps."""
    if strategy == "forward_fill":
        return forward_fill(df, [value], _keys(key), ts, tie)
    if strategy == "median":
        return fill_median(df, value, key, ts)
    if strategy == "mode":
        return fill_mode(df, value, key, ts)
    if strategy == "none":
        return df
    raise OptionError(f"unknown imputation strategy {strategy!r}; known: {STRATEGIES}")
