"""Exact deduplication by content sort.

Texts are dealt to partitions by range, with splitters that Spark samples from (first characters,
hash, slot). Inside a partition an external sort on (first characters, hash, slot, whole text, id)
brings equal texts next to each other; the window over that order compares neighbouring whole texts
and starts a new run wherever they differ. The window finds its rows in place: range partitioning on a
prefix of its keys needs no second shuffle.

A text with more copies than a quarter of a partition's even share is dealt over several slots, so no
task receives an unbounded run. There are at most four such texts per shuffle partition, which
bounds the table that is broadcast; their totals are combined map-side before they meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Characters of a text that go into the sampled splitters.
LEAD_CHARS = 16
# Slots of a hot text hold about total / (HOT_PER_PARTITION * partitions) rows.
HOT_PER_PARTITION = 4
# Runs up to this many rows are never worth a slot of their own.
LEAST_RUN_ROWS = 32


def exact_dedup(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    keep: str = "smallest",
    normalise: Column | None = None,
    carry: bool = True,
) -> DataFrame:
    """Mark one row of every group of equal texts to stay.

    Returns ``row`` (a struct with all columns of ``docs``, so that no name can clash; with ``carry`` off only the key)
    and ``keep_id``, ``group_size``, ``kept``, ``text_sha256``. ``keep`` names the id that stays: ``smallest`` or
    ``largest``. ``normalise`` is the text to compare (default: the column as it is).

    Null texts count as empty and so equal each other and the empty text. Null ids lose against any other id; a group of
    null ids only has a null ``keep_id``. Of fully repeated rows exactly one stays. An empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep!r}")
    spark = docs.sparkSession
    body = F.coalesce(F.col(text) if normalise is None else normalise, F.lit(""))
    # without a normal form the text travels once, and the row is put together again afterwards
    fold = carry and normalise is None
    rest = [c for c in docs.columns if not (fold and c == text)] if carry else [key]
    source = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"),
        F.col(text).isNull().alias("missing"),
        F.col(key).alias("id"),
        body.alias("body"),
        F.xxhash64(body).alias("hash"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bound = max(LEAST_RUN_ROWS, docs.count() // (HOT_PER_PARTITION * parts))
    hot = (
        source.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bound)
        .select(F.col("hash").alias("hot_hash"), F.ceil(F.col("n") / bound).cast("int").alias("slots"))
    )
    dealt = (
        source.join(F.broadcast(hot), F.col("hash") == F.col("hot_hash"), "left")
        .withColumn("slot", F.when(F.col("slots").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.col("slots")).cast("int")))
        .withColumn("lead", F.substring("body", 1, LEAD_CHARS))
    )
    first = F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last()
    run = Window.partitionBy("lead", "hash", "slot", "body").orderBy(first)
    marked = (
        dealt.repartitionByRange("lead", "hash", "slot")
        .withColumn("place", F.row_number().over(run))
        .withColumn("run_id", F.first("id").over(run))
        .withColumn("run_rows", F.count(F.lit(1)).over(run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("text_sha256", F.sha2(F.col("body").cast("binary"), 256))
    )
    best = F.min("id") if keep == "smallest" else F.max("id")
    totals = (
        dealt.where(F.col("slots").isNotNull())
        .groupBy(F.sha2(F.col("body").cast("binary"), 256).alias("hot_sha"))
        .agg(best.alias("hot_id"), F.count(F.lit(1)).alias("hot_rows"))
    )
    joined = marked.join(F.broadcast(totals), F.col("text_sha256") == F.col("hot_sha"), "left")
    keep_id = F.when(F.col("hot_rows").isNull(), F.col("run_id")).otherwise(F.col("hot_id"))
    fields = [
        F.when(~F.col("missing"), F.col("body")).alias(c) if fold and c == text else F.col("rest").getField(c).alias(c)
        for c in (docs.columns if carry else [key])
    ]
    # a null id hashes to one slot, so the first row of the kept id's run is the only one
    return joined.select(
        F.struct(*fields).alias("row"),
        keep_id.alias("keep_id"),
        F.coalesce("hot_rows", "run_rows").alias("group_size"),
        ((F.col("place") == 1) & F.col("id").eqNullSafe(keep_id)).alias("kept"),
        "text_sha256",
    )
