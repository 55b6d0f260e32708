"""Aggregates across the meter columns of one row; no shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattline.errors import OptionError


def _balanced(parts: list[Column], combine) -> Column:
    """Combine pairwise. A left-deep chain over hundreds of columns is too deep for the planner."""
    while len(parts) > 1:
        paired = [combine(a, b) for a, b in zip(parts[::2], parts[1::2])]
        if len(parts) % 2:
            paired.append(parts[-1])
        parts = paired
    return parts[0]


def row_sum(columns: Sequence[str]) -> Column:
    """Sum of the present values; 0.0 when there is none."""
    parts = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]
    return _balanced(parts, lambda a, b: a + b) if parts else F.lit(0.0)


def row_count(columns: Sequence[str]) -> Column:
    """How many values are present."""
    parts = [F.col(c).isNotNull().cast("bigint") for c in columns]
    return _balanced(parts, lambda a, b: a + b) if parts else F.lit(0).cast("bigint")


def row_mean(columns: Sequence[str]) -> Column:
    present = row_count(columns)
    return F.when(present > 0, row_sum(columns) / present)


def _extreme(columns: Sequence[str], pick) -> Column:
    values = [F.col(c).cast("double") for c in columns]
    if not values:
        return F.lit(None).cast("double")
    # least/greatest skip NULL but take two arguments at least
    return pick(*values) if len(values) > 1 else values[0]


ROW_METHODS = {
    "sum": row_sum,
    "mean": row_mean,
    "min": lambda columns: _extreme(columns, F.least),
    "max": lambda columns: _extreme(columns, F.greatest),
}


def row_aggregate(columns: Sequence[str], method: str = "sum") -> Column:
    if method not in ROW_METHODS:
        raise OptionError(f"unknown row aggregate {method!r}; known: {sorted(ROW_METHODS)}")
    return ROW_METHODS[method](columns)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
