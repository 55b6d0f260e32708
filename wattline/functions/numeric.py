"""Text to number, and missing-value rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what counts as a number. Java would also take 1.5d, 1f and 0x1p3.
NUMBER_PATTERN = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)$"
# What is left of a plain decimal once its digits are gone.
_PLAIN_REST = ("", ".", "-", "-.")


def nan_to_null(column: Column) -> Column:
    """NULL is the only marker for a missing number."""
    return F.when(~F.isnan(column), column)


def decimal_point(column: Column) -> Column:
    """Every comma becomes a point."""
    return F.translate(column, ",", ".")


def number_text(column: Column) -> Column:
    """The cell as it is judged: trimmed, with a decimal point."""
    return F.trim(decimal_point(column))


def parse_number(text: Column) -> Column:
    """DOUBLE from :func:`number_text`; what is no number gives NULL instead of failing the job.

    Most cells are plain decimals, and ``translate`` recognises these much
    cheaper than a regular expression does.
    """
    plain = F.translate(text, "0123456789", "").isin(*_PLAIN_REST)
    return F.when(plain | text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def is_text(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StringType, T.VarcharType, T.CharType))


def to_number(column: Column, data_type: T.DataType) -> Column:
    """Number as DOUBLE from a column of any type."""
    if is_text(data_type):
        return parse_number(number_text(column))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return nan_to_null(column.cast("double"))
    return column.cast("double")
