"""Parquet tables the jobs keep: engineered data, predictions, trials, registry, runs, reports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.errors import OptionError, RegistryError
from wattline.sources.commits import CommitLog

METRICS_MAP = T.MapType(T.StringType(), T.DoubleType())
TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


REGISTRY_SCHEMA = _schema(
    version=T.StringType(), model_name=T.StringType(), model_path=T.StringType(), metrics=METRICS_MAP,
    stage=T.StringType(), created_at=T.StringType(),
)
TRIAL_METRICS_SCHEMA = _schema(
    run_id=T.StringType(), model_name=T.StringType(), model_uri=T.StringType(), metrics=METRICS_MAP,
    hyperparameters=TEXT_MAP, training_params=TEXT_MAP, timestamp=T.StringType(),
)
RUN_PHASES_SCHEMA = _schema(
    run_id=T.StringType(), pipeline_name=T.StringType(), run_status=T.StringType(), phase=T.StringType(),
    status=T.StringType(), started_at=T.TimestampNTZType(), ended_at=T.TimestampNTZType(),
    duration_ms=T.LongType(), error_message=T.StringType(), options=TEXT_MAP,
)
REPORT_SCHEMA = _schema(
    run_id=T.StringType(), timestamp=T.StringType(), model_version=T.StringType(), drift_detected=T.BooleanType(),
    baseline_metrics=METRICS_MAP, live_metrics=METRICS_MAP,
)
COMPARISON_SCHEMA = _schema(
    run_id=T.StringType(), timestamp=T.StringType(), model_id=T.StringType(), role=T.StringType(),
    metrics=METRICS_MAP, hyperparameters=TEXT_MAP, artifact_path=T.StringType(), is_champion=T.BooleanType(),
    primary_metric=T.StringType(),
)


def append_rows(spark: SparkSession, path: str, rows: Sequence[tuple], schema: T.StructType) -> None:
    """Append a few records of one run."""
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty one when nothing was ever written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def save_engineered(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Overwrite the engineered table. Parquet by default, so later filters and columns reach the scan."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        writer.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    else:
        raise OptionError(f"unknown table format {fmt!r}; known: parquet, csv")
    return path


def publish(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Replace a published table in one step, and return the folder of its new version.

    The version is written to a folder of its own; a commit then names it the current one. Readers that opened the version before go on with it, and a
    job that fails in the middle leaves the table as it was. `vacuum` removes older versions.
    """
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}/version-{uuid.uuid4().hex}"
    save_engineered(df, folder, fmt, partition_by)
    CommitLog(spark, f"{path.rstrip('/')}/_commits").append({"folder": folder, "format": fmt})
    return folder


def read_published(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The current version of a published table."""
    record = CommitLog(spark, f"{path.rstrip('/')}/_commits").latest()
    if record is None:
        raise OptionError(f"nothing was published at {path!r}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(record["format"]).option("header", True).load(record["folder"])


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Remove all but the last ``keep`` versions, and what failed jobs left; not while such a job runs."""
    table = CommitLog(spark, f"{path.rstrip('/')}/_commits").table(_schema(folder=T.StringType()))
    if table is None:
        return
    # a commit's file is named by its number
    rows = table.select("folder").withColumn("at", F.col("_metadata.file_name")).orderBy(F.desc("at")).limit(keep).collect()
    kept = {r["folder"].rsplit("/", 1)[-1] for r in rows}
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.listStatus(where):
        name = status.getPath().getName()
        if name.startswith("version-") and name not in kept:
            system.delete(status.getPath(), True)


def save_predictions(df: DataFrame, path: str, source: str = "source_file") -> str:
    """One folder per source file. A later job replaces the folders of its own sources only.

    Rebalancing brings a source's rows together, so that few files are written, and splits
    a source too large for one task.
    """
    df.hint("rebalance", F.col(source)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(source).parquet(path)
    return path


def version_number(version):
    """Numeric part of ``v12``; text order would put v9 behind v12."""
    return F.substring(version, 2, 18).try_cast("bigint")


def champion(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The newest record (of each group). A combinable aggregate, no sort."""
    row = F.struct(*[c for c in records.columns if c not in by])
    newest = records.where(F.col("stage") == "champion").groupBy(*by).agg(
        F.max_by(row, version_number(F.col("version"))).alias("_last")
    )
    return newest.where("_last is not null").select(*by, "_last.*")


def registry_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of a registry: its commits, and rows of a table that was written before there were commits."""
    rows = read_table(spark, path, REGISTRY_SCHEMA)
    commits = CommitLog(spark, f"{path.rstrip('/')}/_commits").table(REGISTRY_SCHEMA)
    return rows if commits is None else rows.unionByName(commits)


def register(
    spark: SparkSession, path: str, model_name: str, model_path: str, metrics: dict[str, float], created_at: str
) -> str:
    """Append a record in one commit and return its version. Writers at the same time get versions one after the other."""
    last = read_table(spark, path, REGISTRY_SCHEMA).agg(F.max(version_number(F.col("version")))).first()[0] or 0
    record = {"model_name": model_name, "model_path": model_path, "metrics": metrics, "stage": "champion", "created_at": created_at}
    return f"v{CommitLog(spark, f'{path.rstrip("/")}/_commits').append(record, last + 1, 'version', 'v{}')}"


def load_champion(spark: SparkSession, path: str):
    """The newest champion record, or an error when no model was registered."""
    row = champion(registry_records(spark, path)).first()
    if row is None:
        raise RegistryError(f"no champion in the registry at {path!r}; train a model first")
    return row


def phase_durations(phases: DataFrame) -> DataFrame:
    """Run summary from its phases: status, wall time, and the phases that failed."""
    millis = F.col("duration_ms")
    return phases.groupBy("run_id").agg(
        F.when(F.bool_or(F.col("status") == "FAILED"), F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("run_status"),
        F.count(F.lit(1)).alias("n_phases"),
        F.count_if(F.col("status") == "FAILED").alias("n_failed"),
        F.sum(millis).cast("bigint").alias("total_ms"),
        F.max(millis).alias("longest_ms"),
        F.max_by("phase", F.struct("duration_ms", "phase")).alias("longest_phase"),
    )
