"""From raw text to the engineered table, with its three contract gates."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.errors import OptionError
from wattline.functions.calendar import TIME_FEATURES
from wattline.functions.names import METER_PATTERN, matching
from wattline.functions.numeric import is_text
from wattline.operators.clean import KW_TO_KWH, clean_long, coerce_numeric
from wattline.operators.contracts import ENGINEERED, PREPROCESSED, RAW, Contract
from wattline.operators.features import engineer_long, engineer_wide
from wattline.operators.impute import STRATEGIES, fill_wide, forward_fill, impute_long
from wattline.operators.timed import rejected_rows, timed  # noqa: F401  (rejected_rows is part of this job)
from wattline.sources.delimited import ingest_timestamp
from wattline.storage import materialize


@dataclass(frozen=True)
class PrepareOptions:
    factor: float | None = KW_TO_KWH
    convert: bool = True
    imputation: str = "forward_fill"
    method: str = "sum"
    pattern: str = METER_PATTERN
    flags: Mapping[str, bool] = field(default_factory=lambda: dict.fromkeys(TIME_FEATURES, True))
    target: str = "total_load"
    # "long": one row per meter and time, for hundreds of meters; "wide": row-local, for a few.
    route: str = "long"
    # Rows without timestamp: "fail" the job, or "reject" them, which `rejected_rows` lists.
    untimed: str = "fail"


ROW = "_row"


def _check_types(df: DataFrame, meters: Sequence[str], options: PrepareOptions) -> None:
    texts = [c for c in meters if is_text(df.schema[c].dataType)]
    if texts and not options.convert:
        raise OptionError(f"text columns need convert=True: {texts[:5]}")


def clean_wide(df: DataFrame, options: PrepareOptions, keys: Sequence[str] = ()) -> DataFrame:
    """Coerced, scaled and filled meter columns, one row for each input row."""
    meters = matching(df, options.pattern)
    _check_types(df, meters, options)
    numbers = coerce_numeric(df, meters, options.factor)
    if options.imputation == "none" or not meters:
        return numbers
    # Filling needs two passes: cells are coerced once, and a row's id orders rows that share a timestamp.
    numbers = materialize(numbers.withColumn(ROW, F.monotonically_increasing_id()), "coerced")
    if options.imputation == "forward_fill":
        filled = forward_fill(numbers, meters, keys, tie=ROW)
    else:
        filled = fill_wide(numbers, meters, options.imputation, keys)
    return filled.drop(ROW)


def prepare(df: DataFrame, options: PrepareOptions = PrepareOptions(), keys: Sequence[str] = ()) -> DataFrame:
    """Engineered table from a table with ``timestamp`` and meter columns: one row for each input row, on both routes.

    ``keys`` (such as the source file) separate series that must not fill into each other.
    """
    if options.imputation not in STRATEGIES:
        raise OptionError(f"unknown imputation strategy {options.imputation!r}; known: {STRATEGIES}")
    stamped = timed(df, options.untimed)
    if options.route == "wide":
        return engineer_wide(
            clean_wide(stamped, options, keys), options.method, options.pattern, options.flags, options.target, keys
        )
    if options.route != "long":
        raise OptionError(f"unknown route {options.route!r}; known: long, wide")
    # Meters are told apart by their place: the names are not needed again, and sort and shuffle faster as numbers.
    meters = matching(stamped, options.pattern)
    _check_types(stamped, meters, options)
    numbered = stamped.withColumn(ROW, F.monotonically_increasing_id())
    long = clean_long(numbered, [*keys, "timestamp", ROW], options.convert, options.factor, meters, named=False)
    if options.imputation != "none":
        # Filling needs two passes. The copy holds each row's id, and text is parsed once.
        long = materialize(long, "coerced")
    filled = impute_long(long, options.imputation, key=[*keys, "meter_id"], tie=ROW)
    return engineer_long(filled, options.method, options.flags, options.target, keys, ROW)


def _numeric_schema(schema: T.StructType, options: PrepareOptions) -> T.StructType:
    """The schema after coercion. The long route never builds that table: it coerces after the unpivot."""
    meters = re.compile(options.pattern)
    return T.StructType(
        [
            T.StructField(f.name, T.DoubleType() if options.convert and meters.search(f.name) else f.dataType)
            for f in schema.fields
        ]
    )


def gated(raw: DataFrame, options: PrepareOptions = PrepareOptions(), strict: bool = True) -> DataFrame:
    """Raw gate, ingest, preprocessed gate, features, engineered gate. Gates look at schemas only.

    The raw gate comes before the first column is renamed, in every job.
    """
    Contract(RAW, "raw").check(raw)
    ingested = ingest_timestamp(raw, strict)
    Contract(PREPROCESSED, "preprocessed").check_schema(_numeric_schema(ingested.schema, options))
    engineered = prepare(ingested, options)
    return Contract(ENGINEERED, "engineered").check(engineered)
