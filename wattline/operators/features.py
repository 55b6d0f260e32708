"""The engineered table: row aggregate and calendar columns, meters dropped."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.errors import OptionError
from wattline.functions.calendar import TIME_FEATURES
from wattline.functions.names import METER_PATTERN, METER_PREFIX, matching, quote
from wattline.functions.rowwise import ROW_METHODS, row_aggregate

TARGET = "total_load"


def with_row_aggregate(
    df: DataFrame, method: str = "sum", pattern: str = METER_PATTERN, out: str = TARGET
) -> DataFrame:
    return df.withColumn(out, row_aggregate(matching(df, pattern), method).cast("double"))


def with_time_features(df: DataFrame, flags: Mapping[str, bool] | None = None, ts: str = "timestamp") -> DataFrame:
    """Calendar columns whose flag is not off."""
    flags = dict.fromkeys(TIME_FEATURES, True) if flags is None else flags
    unknown = set(flags) - set(TIME_FEATURES)
    if unknown:
        raise OptionError(f"unknown time features {sorted(unknown)}")
    return df.withColumns({n: make(F.col(ts)) for n, make in TIME_FEATURES.items() if flags.get(n, False)})


def column_roles(schema: T.StructType, target: str = TARGET, ts: str = "timestamp", keep: Sequence[str] = ()) -> dict[str, str]:
    """What each column is to the engineered table: key, time, target, feature, or unused (meters and text)."""

    def role(field: T.StructField) -> str:
        if field.name in keep:
            return "key"
        if field.name == ts:
            return "time"
        if field.name == target:
            return "target"
        is_feature = isinstance(field.dataType, T.NumericType) and not field.name.startswith(METER_PREFIX)
        return "feature" if is_feature else "unused"

    return {f.name: role(f) for f in schema.fields}


def feature_projection(
    df: DataFrame, target: str = TARGET, ts: str = "timestamp", keep: Sequence[str] = ()
) -> DataFrame:
    """Keys, time, then numeric target and features in their order; a target that is no number comes last."""
    roles = column_roles(df.schema, target, ts, keep)
    measured = isinstance(df.schema[target].dataType, T.NumericType) if target in roles else True
    rank = {"key": 0, "time": 1, "feature": 2, "target": 2 if measured else 3}
    order = {**{c: i for i, c in enumerate(keep)}, **{c: i + len(keep) for i, c in enumerate(df.columns) if c not in keep}}
    used = sorted((c for c, r in roles.items() if r in rank), key=lambda c: (rank[roles[c]], order[c]))
    return df.select(*[F.col(quote(c)) for c in used])


def dropped_columns(before: DataFrame, after: DataFrame) -> list[str]:
    return sorted(set(before.columns) - set(after.columns))


def engineer_wide(
    df: DataFrame,
    method: str = "sum",
    pattern: str = METER_PATTERN,
    flags: Mapping[str, bool] | None = None,
    target: str = TARGET,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Row-local: no shuffle however many rows there are."""
    return feature_projection(with_time_features(with_row_aggregate(df, method, pattern), flags), target, keep=keep)


_LONG_METHODS = {
    "sum": lambda v: F.coalesce(F.sum(v), F.lit(0.0)),
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
}


def total_by_time(
    long: DataFrame, method: str = "sum", value: str = "value", keys: Sequence[str] = ("timestamp",), out: str = TARGET
) -> DataFrame:
    """The row aggregate on long data: partial sums are combined before the shuffle."""
    if method not in ROW_METHODS:
        raise OptionError(f"unknown row aggregate {method!r}; known: {sorted(ROW_METHODS)}")
    return long.groupBy(*keys).agg(_LONG_METHODS[method](F.col(value)).cast("double").alias(out))


def engineer_long(
    long: DataFrame,
    method: str = "sum",
    flags: Mapping[str, bool] | None = None,
    target: str = TARGET,
    keep: Sequence[str] = (),
    row: str | None = None,
) -> DataFrame:
    """The long form's table; ``row`` names the column that tells apart input rows which share a timestamp."""
    totals = total_by_time(long, method, keys=[*keep, "timestamp", *([row] if row else [])], out=TARGET)
    if row:
        totals = totals.drop(row)
    return feature_projection(with_time_features(totals, flags), target, keep=keep)
