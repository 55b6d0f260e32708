"""Mixing sources to target weights by systematic sampling.

Within a source the documents are ordered by size, every document's expected copies are added up in that order, one
random offset per source is added, and a document is emitted once for every integer that its interval crosses. The
order by size makes the sample follow the distribution of sizes, so the words taken come near the target.

The prefix sums run over a range partitioning on (source, size, key): a source that holds a third of all
rows spans many partitions. Sums per partition are combined, and a window over that small table carries them
across. Expected copies are decimals, so a prefix does not depend on the order in which parts were added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.storage import materialize

#: A word is a maximal run of characters other than these.
WORD = r"[^\x20\x09-\x0D]+"
COPIES = "decimal(34,15)"


def word_count(text: str = "text") -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, source: str, size: str, weights: Sequence[float], share: float, cap: float
) -> DataFrame:
    """Target of every source: (source, source_size, target).

    ``sizes`` has any number of rows per source. Sources in code point order, null last, get ``weights`` in turn. Together
    they get ``share`` times all sizes. No target passes ``cap`` times its source's size: what is above goes to the
    others by weight. That is the level L with sum(min(weight * L, cap * size)) equal to the whole; it lies behind the
    sources, ordered by cap / weight, which are full. A source without words has target 0.
    """
    totals = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighed = (
        totals.withColumn("turn", turn)
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("turn") + 1))
        .withColumn("limit", F.lit(float(cap)) * F.col("source_size"))
    )
    # one row per source: these windows see sources, never documents
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    filled = (
        weighed.withColumn("whole", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("full_before", F.sum("limit").over(order) - F.col("limit"))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.sum("weight").over(order) + F.col("weight"))
        .withColumn("level", (F.col("whole") - F.col("full_before")) / F.col("weight_left"))
        .withColumn("is_full", F.col("weight") * F.col("level") >= F.col("limit"))
        # the first source that is not full sets the level of all behind it
        .withColumn("set_level", F.first(F.when(~F.col("is_full"), F.col("level")), True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    target = F.when(F.col("set_level").isNull(), F.col("limit")).otherwise(F.least(F.col("weight") * F.col("set_level"), F.col("limit")))
    return filled.select("source", "source_size", target.alias("target"))


def random_offset(source: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the source and the seed alone."""
    word = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.concat(F.lit("s"), source), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(word, 1, 12), 16, 10).cast("decimal(20,0)") / F.lit(1 << 48).cast("decimal(20,0)")


def systematic_copies(rows: DataFrame, source: str, order: Sequence[str], expected: str, seed: int) -> DataFrame:
    """Add ``copies``: how often each row is drawn, given its expected copies.

    Two passes over narrow rows: they are range-partitioned by (source, order) and written with their partition, sums per
    (source, partition) give the start of each part, and a window inside each part adds up its rows.
    """
    keys = [F.col(source).asc_nulls_last(), *[F.col(c) for c in order]]
    placed = materialize(
        rows.withColumn(expected, F.col(expected).cast(COPIES)).repartitionByRange(*keys).withColumn("part", F.spark_partition_id()),
        "mix-order",
    )
    starts = (
        placed.groupBy(F.col(source).alias("of_source"), F.col("part").alias("of_part"))
        .agg(F.sum(expected).cast(COPIES).alias("within"))
        .withColumn("start", F.sum("within").over(Window.partitionBy("of_source").orderBy("of_part")).cast(COPIES) - F.col("within"))
        .drop("within")
    )
    before = Window.partitionBy("part", source).orderBy(*[F.col(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("start") + F.sum(expected).over(before).cast(COPIES)
    offset = random_offset(F.col(source), seed).cast(COPIES)
    high = F.floor(upto + offset)
    low = F.floor(upto - F.col(expected) + offset)
    same = (F.col("part") == F.col("of_part")) & F.col(source).eqNullSafe(F.col("of_source"))
    return placed.join(starts, same).withColumn("copies", (high - low).cast("long")).drop("of_source", "of_part", "start", "part")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float],
    share: float,
    cap: float,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    seed: int = 17,
) -> DataFrame:
    """One row per document: key, source, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    Null texts have size 0 and take nothing. Null sources are one source. Null keys come first among equal sizes, and
    fully repeated rows are separate documents, each with its own draw. The same input and seed draw the same
    documents. An empty table gives an empty result. Output columns are renamed to doc_id and source.
    """
    sized = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"))
    sized = materialize(sized, "mix-size")
    targets = source_targets(sized, "source", "size", weights, share, cap).withColumnRenamed("source", "target_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    hinted = sized.join(targets, F.col("source").eqNullSafe(F.col("target_source"))).drop("target_source")
    hinted = hinted.withColumn("expected", ratio).withColumn("falling", -F.col("size"))
    drawn = systematic_copies(hinted, "source", ["falling", "doc_id"], "expected", seed)
    return drawn.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeat_rows(docs: DataFrame, drawn: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents of the mix: every row of ``docs`` as often as ``drawn`` has copies for it, with the columns of ``docs``.

    Rows are met by key, null keys with null keys. Rows that share a key get the sum of their copies in even parts.
    """
    picked = drawn.groupBy(F.xxhash64("doc_id").alias("of_hash"), F.col("doc_id").alias("of_key")).agg(
        F.sum("copies").alias("all_copies"), F.count(F.lit(1)).alias("all_rows")
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(F.col(key)).alias("hash"))
    met = rows.join(
        picked.where(F.col("all_copies") > 0),
        (F.col("hash") == F.col("of_hash")) & F.col("row").getField(key).eqNullSafe(F.col("of_key")),
    )
    place = F.row_number().over(Window.partitionBy("hash", "of_key").orderBy(F.xxhash64("row"))) - 1
    part = F.floor(F.col("all_copies") / F.col("all_rows")) + F.when(place < F.col("all_copies") % F.col("all_rows"), 1).otherwise(0)
    dealt = met.withColumn("copies", part.cast("int")).where(F.col("copies") > 0)
    return dealt.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
