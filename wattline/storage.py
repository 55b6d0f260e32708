"""Shared storage for intermediate tables, and joins against small tables.

Intermediate results are written as Parquet below the folder named by
``spark.checkpoint.dir``. A written table survives the loss of executors, cuts
the lineage, and gives Catalyst the real size of the table.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A side of a join is broadcast up to this many rows; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
# Number of copies of the smaller side in the salted join.
SALTS = 32


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by the session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    base = context.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="wattline-")
    context.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder, grouped by application for later removal."""
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/wattline/{application}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to shared storage and return a scan of it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of the library's own that is no longer needed; a missing one is no error."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def attach(
    df: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str | Column] = (),
    rows: int | None = None,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join ``small`` (one row per key) to ``df``.

    The small side is broadcast when its row count is within the bound. Beyond
    that both sides shuffle on the keys plus a salt derived from ``spread_by``, so that
    one key holding a large share of ``df`` is spread over ``SALTS`` tasks. Without
    ``spread_by`` the shuffle is on the keys alone, for keys whose rows are bounded already.
    """
    if rows is None:
        rows = small.count()
    extra = [c for c in small.columns if c not in keys]
    # A NULL key is a key like any other: it has its own rows and its own statistics.
    other = small.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *extra)
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    columns = [*df.columns, *extra]
    if rows <= max_broadcast_rows:
        return df.join(F.broadcast(other), same, "left").select(*columns)
    if not spread_by:
        return df.join(other, same, "left").select(*columns)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int"))
    copies = other.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*same, F.col("_salt") == F.col("_copy")], "left").select(*columns)
