"""Selecting columns by name or type; works on schemas only."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# How meter columns are named.
METER_PATTERN = r"^MT_\d{3}$"
METER_PREFIX = "MT_"


def matching(df: DataFrame, pattern: str = METER_PATTERN) -> list[str]:
    """Columns in which the pattern is found."""
    found = re.compile(pattern)
    return [c for c in df.columns if found.search(c)]


def prefixed(df: DataFrame, prefix: str = METER_PREFIX) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def numeric(df: DataFrame) -> list[str]:
    """Numeric columns; booleans are not numbers."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
