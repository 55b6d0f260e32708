"""Table diagnostics, each one pass over the needed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.names import METER_PREFIX, prefixed, quote
from wattline.operators.clean import to_long
from wattline.operators.contracts import type_name


def profile_columns(df: DataFrame) -> DataFrame:
    """(column, dtype, n_rows, non_null, nulls), one row per column."""
    counts = [F.count(F.col(quote(f.name))).alias(f"_n{i}") for i, f in enumerate(df.schema.fields)]
    rows = F.col("_rows")
    lines = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(type_name(f.dataType)).alias("dtype"),
            rows.alias("n_rows"),
            F.col(f"_n{i}").alias("non_null"),
            (rows - F.col(f"_n{i}")).alias("nulls"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.count(F.lit(1)).alias("_rows"), *counts).select(F.inline(F.array(*lines)))


def decimal_format(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How each text column writes its numbers; the first rule that holds wins.

    ``comma``: some cell has a comma; ``zeros``: all are zero; ``whole``: all are digits; else ``no_comma``.
    Runs on long form, so hundreds of columns do not pile up in one aggregation.
    """
    columns = prefixed(df, METER_PREFIX) if columns is None else list(columns)
    texts = df.select(*[F.col(quote(c)).cast("string").alias(c) for c in columns])
    cells = to_long(texts, columns, (), "column", "cell")
    cell = F.coalesce(F.col("cell"), F.lit("nan"))
    flags = cells.groupBy("column").agg(
        F.bool_or(cell.contains(",")).alias("comma"),
        F.bool_and(F.coalesce(cell.try_cast("double") == 0, F.lit(False))).alias("zeros"),
        F.bool_and(cell.rlike(r"^\d+$")).alias("whole"),
    )
    kind = F.when(F.col("comma"), "comma").when(F.col("zeros"), "zeros").when(F.col("whole"), "whole").otherwise("no_comma")
    return flags.select("column", kind.alias("decimal_format"))


def clean_checks(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Raw against cleaned cells that sit in the same row: ``pairs`` maps a name to (raw, cleaned).

    (column, has_missing, zeros, unexpected_zeros, lost_cells): zeros are unexpected when not every
    raw cell has a 0 in it; a lost cell had text and has no number.
    """
    names = list(pairs)
    entries = F.array(
        *[
            F.struct(
                F.lit(n).alias("column"),
                F.col(pairs[n][0]).cast("string").alias("raw"),
                F.col(pairs[n][1]).cast("double").alias("clean"),
            )
            for n in names
        ]
    )
    raw, clean = F.coalesce(F.col("raw"), F.lit("nan")), F.col("clean")
    checks = df.select(F.inline(entries)).groupBy("column").agg(
        F.bool_or(clean.isNull()).alias("has_missing"),
        F.count_if(clean == 0).alias("zeros"),
        F.bool_and(raw.contains("0")).alias("_all_zero_text"),
        F.count_if(F.col("raw").isNotNull() & clean.isNull()).alias("lost_cells"),
    )
    unexpected = (F.col("zeros") > 0) & ~F.col("_all_zero_text")
    return checks.select("column", "has_missing", "zeros", unexpected.alias("unexpected_zeros"), "lost_cells")


def total_load_check(wide: DataFrame, long: DataFrame, target: str = "total_load", ts: str = "timestamp") -> DataFrame:
    """Largest difference between the row aggregate's wide and long routes over all timestamps, and rows that only one has.

    Totals are added up per timestamp, and so are rows, as +1 and -1: a route that merges repeated timestamps shows.
    """
    one = F.lit(1).cast("bigint")
    signed = wide.select(ts, F.col(target).alias("_v"), one.alias("_r")).unionAll(long.select(ts, (-F.col(target)).alias("_v"), (-one).alias("_r")))
    differences = signed.groupBy(ts).agg(F.abs(F.sum("_v")).alias("_d"), F.abs(F.sum("_r")).alias("_n"))
    return differences.agg(F.count(F.lit(1)).alias("timestamps"), F.max("_d").alias("max_abs_diff"), F.sum("_n").alias("row_difference"))


def first_rows(df: DataFrame, n: int = 5, ts: str = "timestamp") -> DataFrame:
    """The report's sample: the first rows in time, by a bounded top-k and no full sort."""
    return df.orderBy(ts).limit(n)
