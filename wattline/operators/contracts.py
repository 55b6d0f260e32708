"""Schema contracts: what a table must look like at a gate of the job.

Checking a contract reads the schema only; no job runs.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.errors import ContractError
from wattline.functions.numeric import to_number
from wattline.functions.rowwise import all_of

# Type names used in contracts.
# These names stand for a set of types ...
ALIASES = {
    "object": ("object", "str"),
    "str": ("object", "str"),
    "float": ("float64", "float32", "float"),
    "int": ("int64", "int32", "int"),
}
# ... and these are the names of the Spark types.
TYPE_NAMES = {
    "string": "object",
    "double": "float64",
    "float": "float32",
    "bigint": "int64",
    "int": "int32",
    "smallint": "int16",
    "tinyint": "int8",
    "boolean": "bool",
    "timestamp_ntz": "datetime64[us]",
    "timestamp": "datetime64[us, UTC]",
    "date": "date",
}
SPARK_TYPES = {
    "object": T.StringType(),
    "str": T.StringType(),
    "float": T.DoubleType(),
    "float64": T.DoubleType(),
    "float32": T.FloatType(),
    "int": T.LongType(),
    "int64": T.LongType(),
    "int32": T.IntegerType(),
    "bool": T.BooleanType(),
    "datetime64[us]": T.TimestampNTZType(),
}
# The three gates.
RAW = (
    {"column": "Unnamed: 0", "type": "object"},
    {"column_pattern": r"^MT_\d{3}$", "type": "object"},
)
PREPROCESSED = (
    {"column": "timestamp", "type": "datetime64[us]"},
    {"column_pattern": r"^MT_\d{3}$", "type": "float64"},
)
ENGINEERED = (
    {"column": "timestamp", "type": "datetime64[us]"},
    {"column": "hour_of_day", "type": "int64"},
    {"column": "day_of_week", "type": "int64"},
    {"column": "is_weekend", "type": "int64"},
    {"column": "total_load", "type": "float64"},
)


def type_name(data_type: T.DataType) -> str:
    plain = data_type.simpleString()
    return TYPE_NAMES.get(plain, plain)


def accepts(expected: str, actual: str) -> bool:
    """Alias names match their set only; any other name must occur in the actual one."""
    if expected in ALIASES:
        return actual in ALIASES[expected]
    return expected in actual


@dataclass(frozen=True)
class Item:
    """One contract line: an exact column or a pattern, and its type."""

    type: str
    column: str | None = None
    column_pattern: str | None = None


@dataclass(frozen=True)
class Violation:
    contract: str
    column: str
    expected: str
    actual: str | None
    kind: str


class Contract:
    """Named set of exact columns and column patterns with their types."""

    def __init__(self, items: Iterable[Item | Mapping[str, str]] | Mapping[str, str], name: str = "contract"):
        self.name = name
        self.exact: dict[str, str] = {}
        self.patterns: list[tuple[re.Pattern[str], str]] = []
        if isinstance(items, Mapping):
            self.exact.update(items)
        elif isinstance(items, (list, tuple)):
            for item in items:
                self._add(item)
        else:
            raise TypeError("a contract is a list of items or a mapping of column to type")

    def _add(self, item: Item | Mapping[str, str]) -> None:
        if not isinstance(item, Item):
            if "column" not in item and "column_pattern" not in item:
                raise KeyError("a contract item needs 'column' or 'column_pattern'")
            item = Item(item["type"], item.get("column"), item.get("column_pattern"))
        if item.column:
            self.exact[item.column] = item.type
        if item.column_pattern:
            self.patterns.append((re.compile(item.column_pattern), item.type))

    def expand(self, columns: Iterable[str]) -> dict[str, str]:
        """Column to type for this header; a pattern's type wins over an exact one."""
        expected = dict(self.exact)
        for pattern, kind in self.patterns:
            expected.update({c: kind for c in columns if pattern.match(c)})
        return expected

    def read_schema(self, columns: list[str], other: T.DataType = T.StringType()) -> T.StructType:
        """Schema for a typed read of a file with this header."""
        expected = self.expand(columns)
        return T.StructType(
            [T.StructField(c, SPARK_TYPES[expected[c]] if c in expected else other) for c in columns]
        )

    def violations(self, schema: T.StructType) -> list[Violation]:
        actual = {f.name: type_name(f.dataType) for f in schema.fields}
        found = []
        for column, kind in self.expand(list(actual)).items():
            if column not in actual:
                found.append(Violation(self.name, column, kind, None, "missing"))
            elif not accepts(kind, actual[column]):
                found.append(Violation(self.name, column, kind, actual[column], "type"))
        return found

    def check_schema(self, schema: T.StructType) -> None:
        """An error that names every breach."""
        found = self.violations(schema)
        if found:
            lines = "; ".join(f"{v.column}: expected {v.expected}, {v.actual or 'missing'}" for v in found)
            raise ContractError(f"contract {self.name!r} is broken: {lines}")

    def check(self, df: DataFrame) -> DataFrame:
        """``df`` itself when it keeps the contract."""
        self.check_schema(df.schema)
        return df


def conformance(df: DataFrame, contract: Contract) -> DataFrame:
    """Per contract column: declared and actual type, kind of breach, and how many cells do not convert.

    One pass over the needed columns. Output: (contract, column, expected, actual, kind, cells, bad_cells).
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    breaches = {v.column: v for v in contract.violations(df.schema)}
    expected = contract.expand(list(fields))
    counts, lines = [], []
    for i, (column, kind) in enumerate(expected.items()):
        breach = breaches.get(column)
        if column in fields:
            cell = F.col(f"`{column}`")
            converted = converts(cell, fields[column], kind)
            counts.append(F.count(cell).alias(f"_cells{i}"))
            counts.append(F.count_if(cell.isNotNull() & converted.isNull()).alias(f"_bad{i}"))
        line = [
            F.lit(contract.name).alias("contract"),
            F.lit(column).alias("column"),
            F.lit(kind).alias("expected"),
            F.lit(type_name(fields[column]) if column in fields else None).cast("string").alias("actual"),
            F.lit(breach.kind if breach else "ok").alias("kind"),
            (F.col(f"_cells{i}") if column in fields else F.lit(0).cast("bigint")).alias("cells"),
            (F.col(f"_bad{i}") if column in fields else F.lit(0).cast("bigint")).alias("bad_cells"),
        ]
        lines.append(F.struct(*line))
    return df.agg(*counts).select(F.inline(F.array(*lines)))


def converts(cell, data_type: T.DataType, kind: str):
    """The cell in the declared type, NULL where it does not convert."""
    target = SPARK_TYPES[kind]
    if isinstance(target, (T.DoubleType, T.FloatType)):
        return to_number(cell, data_type)
    return cell.try_cast(target)


def quarantine(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Rows whose cells all convert, in the declared types, and the other rows with their reasons.

    Missing timestamps are refused too: a row without one has no place in a series.
    """
    missing = [v for v in contract.violations(df.schema) if v.kind == "missing"]
    if missing:
        raise ContractError(f"contract {contract.name!r}: missing columns {[v.column for v in missing]}")
    fields = {f.name: f.dataType for f in df.schema.fields}
    expected = contract.expand(list(fields))
    tests, typed = [], []
    for column, data_type in fields.items():
        cell = F.col(f"`{column}`")
        if column not in expected:
            typed.append(cell)
            continue
        converted = converts(cell, data_type, expected[column])
        typed.append(converted.cast(SPARK_TYPES[expected[column]]).alias(column))
        refused = cell.isNotNull() & converted.isNull()
        if isinstance(SPARK_TYPES[expected[column]], T.TimestampNTZType):
            refused = converted.isNull()
        tests.append((column, refused))
    reasons = F.array_compact(F.array(*[F.when(bad, F.lit(c)) for c, bad in tests]))
    good = df.where(all_of([~bad for _, bad in tests])).select(*typed)
    bad = df.select("*", reasons.alias("bad_columns")).where(F.size("bad_columns") > 0)
    return good, bad
