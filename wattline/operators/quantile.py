"""Exact medians that hold when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.storage import attach, materialize

# Keys with more rows than this do not go through the built-in, whose state holds
# every distinct value of a key in one task.
HOT_ROWS = 2_000_000
# Each round cuts a hot key's bracket into this many cells.
_CELLS = 64
_SKETCH = 1_000


def exact_median(df: DataFrame, keys: Sequence[str], value: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Median per key (mean of the two middle values), missing values left out: (keys, value)."""
    keys = list(keys)
    number = F.col(value).cast("double")
    present = df.select(*keys, number.alias(value)).where(F.col(value).isNotNull() & ~F.isnan(value))
    sizes = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = materialize(sizes.where(F.col("_n") > hot_rows), "hot-keys")
    n_hot = hot.count()
    if n_hot == 0:
        return present.groupBy(*keys).agg(F.median(value).alias(value))
    marked = attach(present, hot, keys, [value], rows=n_hot)
    usual = marked.where(F.col("_n").isNull()).groupBy(*keys).agg(F.median(value).alias(value))
    return usual.unionByName(_narrowed(marked.where(F.col("_n").isNotNull()), hot, n_hot, keys, value, hot_rows))


def _narrowed(rows: DataFrame, hot: DataFrame, n_hot: int, keys: list[str], value: str, hot_rows: int) -> DataFrame:
    """Narrow a bracket of values around the middle until few are left, then count through it.

    Rows shrink to (key, value, count) first. A sketch proposes cell borders, exact counts
    tell which cells hold the two middle ranks; a poor sketch costs a round, never the result.
    """
    counts = materialize(rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c")), "value-counts")
    rank_low = F.floor((F.col("_n") + 1) / 2)
    rank_high = F.floor((F.col("_n") + 2) / 2)
    bracket = hot.select(
        *keys,
        "_n",
        F.lit(float("-inf")).alias("_lo"),
        F.lit(float("inf")).alias("_hi"),
        F.lit(0).cast("bigint").alias("_below"),
    )

    def inside(limits: DataFrame) -> DataFrame:
        joined = attach(counts, limits, keys, [value], rows=n_hot)
        return joined.where((F.col(value) >= F.col("_lo")) & (F.col(value) <= F.col("_hi")))

    shares = [i / _CELLS for i in range(1, _CELLS)]
    # ends when the brackets are small, or hold no more than the values around the middle
    crowd = None
    while True:
        live = inside(bracket)
        borders = materialize(
            live.groupBy(*keys).agg(F.percentile_approx(value, shares, _SKETCH).alias("_borders")), "borders"
        )
        placed = attach(live, borders, keys, [value], rows=n_hot).withColumn(
            "_cell", F.size(F.filter("_borders", lambda b: b < F.col(value)))
        )
        cells = placed.groupBy(*keys, "_cell").agg(
            F.sum("_c").alias("_c"),
            F.count(F.lit(1)).alias("_values"),
            F.min(value).alias("_lo"),
            F.max(value).alias("_hi"),
            F.max("_n").alias("_n"),
            F.max("_below").alias("_below"),
        )
        # at most _CELLS rows per hot key
        run = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("_before", F.col("_below") + F.coalesce(F.sum("_c").over(run), F.lit(0)))
        middle = cells.where((F.col("_before") < rank_high) & (F.col("_before") + F.col("_c") >= rank_low))
        found = materialize(
            middle.groupBy(*keys).agg(
                F.max("_n").alias("_n"),
                F.min("_lo").alias("_lo"),
                F.max("_hi").alias("_hi"),
                F.min("_before").alias("_below"),
                F.sum("_values").alias("_values"),
            ),
            "bracket",
        )
        bracket = found.drop("_values")
        before, crowd = crowd, found.agg(F.max("_values").alias("m")).first()["m"]
        if crowd is None or crowd <= hot_rows or crowd == before:
            break

    run = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = inside(bracket).withColumn("_upto", F.col("_below") + F.sum("_c").over(run))
    ends = reached.groupBy(*keys).agg(
        F.min(F.when(F.col("_upto") >= rank_low, F.col(value))).alias("_a"),
        F.min(F.when(F.col("_upto") >= rank_high, F.col(value))).alias("_b"),
    )
    return ends.select(*keys, ((F.col("_a") + F.col("_b")) / 2).alias(value))
