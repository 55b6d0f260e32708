"""From raw text columns to scaled numbers, in wide and in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.errors import OptionError
from wattline.functions.names import METER_PATTERN, matching, quote
from wattline.functions.numeric import decimal_point, is_text, number_text, parse_number, to_number

# Fixed value: quarter-hour kW to kWh.
KW_TO_KWH = 0.25


def select_meters(df: DataFrame, pattern: str = METER_PATTERN, keep: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Kept columns plus the meter columns."""
    return df.select(*[c for c in keep if c in df.columns], *[c for c in matching(df, pattern) if c not in keep])


def normalize_decimals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Decimal commas become points in text columns; numbers stay as they are."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    chosen = set(columns) & text
    return df.select(*[decimal_point(F.col(quote(c))).alias(c) if c in chosen else F.col(quote(c)) for c in df.columns])


def coerce_numeric(df: DataFrame, columns: Sequence[str] | None = None, factor: float | None = None) -> DataFrame:
    """Numbers from text with decimal comma, missing where there is none, scaled by ``factor``.

    All columns change together in two projections, text first, so that each text is made once;
    a chain of hundreds of projections would not plan.
    """
    chosen = set(matching(df) if columns is None else columns)
    texts = {f.name for f in df.schema.fields if f.name in chosen and is_text(f.dataType)}
    types = {f.name: f.dataType for f in df.schema.fields}

    def number(name: str):
        cell = F.col(quote(name))
        if name not in chosen:
            return cell
        made = parse_number(cell) if name in texts else to_number(cell, types[name])
        return (made * F.lit(float(factor)) if factor is not None else made).alias(name)

    if texts:
        df = df.select(*[number_text(F.col(quote(c))).alias(c) if c in texts else F.col(quote(c)) for c in df.columns])
    return df.select(*[number(c) for c in df.columns])


def scale_meters(df: DataFrame, factor: float = KW_TO_KWH, pattern: str = METER_PATTERN) -> DataFrame:
    chosen = set(matching(df, pattern))
    return df.select(*[(F.col(c) * F.lit(float(factor))).alias(c) if c in chosen else F.col(quote(c)) for c in df.columns])


def to_long(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = ("timestamp",),
    meter: str = "meter_id",
    value: str = "value",
    named: bool = True,
) -> DataFrame:
    """One row per (timestamp, meter); a meter is its name or, not ``named``, its place among the columns.

    The cells of a row go through one array and their names come from a constant one: over
    hundreds of columns several times faster than ``unpivot``, which plans one projection per column.
    """
    columns = matching(df) if columns is None else list(columns)
    if not columns:
        raise OptionError("no meter columns to unpivot")
    cells = df.select(*keys, F.posexplode(F.array(*[F.col(quote(c)) for c in columns])).alias("_place", value))
    if not named:
        return cells.withColumnRenamed("_place", meter)
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_place") + 1)
    return cells.select(*keys, name.alias(meter), value)


def clean_long(
    df: DataFrame,
    keys: Sequence[str] = ("timestamp",),
    convert: bool = True,
    factor: float | None = KW_TO_KWH,
    columns: Sequence[str] | None = None,
    named: bool = True,
) -> DataFrame:
    """Unpivot first, while all meters share one type: each later rule is then one expression."""
    long = to_long(df, columns, keys, named=named)
    if convert:
        return coerce_numeric(long, ["value"], factor)
    if factor is not None:
        return long.withColumn("value", F.col("value") * F.lit(float(factor)))
    return long
