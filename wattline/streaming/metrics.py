"""Live metrics that report every window and lose no row.

State are the sums of the open windows and the newest time that was seen. A window closes once the newest time is ``lateness`` beyond its end, as a
watermark would have it; a row of a closed window is late and goes to a table of its own, as does a row without a timestamp. At the end of a bounded
run the open windows are results too, marked as not final. Every write is keyed by the batch id, so a batch that runs again replaces
only its own output.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wattline.functions.calendar import MICROS_PER_SECOND, from_wall_micros, wall_micros
from wattline.operators.drift import DRIFT_THRESHOLD, drift_flag
from wattline.storage import remove, scratch_path

_SUMS = "n_rows long, n_used long, squares double"


@dataclass(frozen=True)
class LiveMetrics:
    """Paths and options of one run of metrics over a stream of ``ts, label, prediction``."""

    base: str
    baseline_rmse: float
    ts: str = "ts"
    by: Sequence[str] = ()
    width_seconds: int = 86_400
    lateness_seconds: int = 3_600
    threshold: float = DRIFT_THRESHOLD

    def _part(self, table: str, batch_id: int) -> str:
        return f"{self.base}/{table}/batch_id={batch_id}"

    def _state(self, spark: SparkSession, batch_id: int, schema: T.StructType) -> tuple[DataFrame, int | None]:
        """Open windows and newest time behind a batch; before the first one there are none."""
        if batch_id < 0:
            return spark.createDataFrame([], schema), None
        newest = spark.read.schema("newest long").parquet(self._part("newest", batch_id)).first()["newest"]
        return spark.read.schema(schema).parquet(self._part("open", batch_id)), newest

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = scratch_path(spark, "metrics-batch")
        batch.write.parquet(held)
        rows = spark.read.schema(batch.schema).parquet(held)
        width, late_by = self.width_seconds * MICROS_PER_SECOND, self.lateness_seconds * MICROS_PER_SECOND
        keys = ["window", *self.by]
        schema = T.StructType([T.StructField("window", T.LongType()), *(batch.schema[c] for c in self.by), *T.StructType.fromDDL(_SUMS)])
        known, newest = self._state(spark, batch_id - 1, schema)
        at = wall_micros(F.col(self.ts))
        placed = rows.withColumn("_at", at).withColumn("window", F.floor(F.col("_at") / width) * width)
        placed.where("_at is null").select(*rows.columns).write.mode("overwrite").parquet(self._part("untimed", batch_id))
        is_late = F.lit(False) if newest is None else F.col("window") + width <= F.lit(newest - late_by)
        timely = placed.where("_at is not null")
        timely.where(is_late).select(*rows.columns).write.mode("overwrite").parquet(self._part("late", batch_id))
        squared = F.pow(F.col("label") - F.col("prediction"), 2)
        fresh = timely.where(~is_late).groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n_rows"), F.count(squared).alias("n_used"), F.coalesce(F.sum(squared), F.lit(0.0)).alias("squares")
        )
        both = known.unionByName(fresh).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_used", "squares")])
        seen = rows.agg(F.max(at)).first()[0]
        newest = max((x for x in (newest, seen) if x is not None), default=None)
        # sums go to the scratch folder first: closed and open windows are two parts of one result
        sums = f"{held}-sums"
        both.write.parquet(sums)
        windows = spark.read.schema(schema).parquet(sums)
        closes = F.lit(False) if newest is None else F.col("window") + width <= F.lit(newest - late_by)
        windows.where(closes).write.mode("overwrite").parquet(self._part("closed", batch_id))
        windows.where(~closes).write.mode("overwrite").parquet(self._part("open", batch_id))
        spark.createDataFrame([(newest,)], "newest long").coalesce(1).write.mode("overwrite").parquet(self._part("newest", batch_id))
        # a repeated batch needs the state before it, and none older
        for table in ("open", "newest"):
            remove(spark, self._part(table, batch_id - 2))
        remove(spark, held)
        remove(spark, sums)

    def start(self, stream: DataFrame, available_now: bool = True) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", f"{self.base}/checkpoint")
        return writer.trigger(availableNow=True).start() if available_now else writer.start()

    def _all(self, spark: SparkSession, table: str) -> DataFrame | None:
        try:
            return spark.read.parquet(f"{self.base}/{table}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return None

    def result(self, spark: SparkSession) -> DataFrame | None:
        """A row per window, closed or open as of the last batch (``is_final``): counts, errors and the drift flag. None before any batch.

        ``n_rows`` are all rows of the window; the errors are of those with label and prediction, and null without any.
        """
        closed, open_ = self._all(spark, "closed"), self._all(spark, "open")
        if closed is None or open_ is None:
            return None
        last = open_.agg(F.max("batch_id")).first()[0]
        if last is None:  # no window is open: the folder of the last batch has no row to say so
            rows = closed.withColumn("is_final", F.lit(True))
        else:
            newest = self._all(spark, "newest").agg(F.max("batch_id")).first()[0]
            rows = closed.withColumn("is_final", F.lit(True)).unionByName(open_.where(F.col("batch_id") == newest).withColumn("is_final", F.lit(False)))
        mse = F.when(F.col("n_used") > 0, F.col("squares") / F.col("n_used"))
        return rows.select(
            from_wall_micros(F.col("window")).alias("window_start"), *self.by, "n_rows", F.sqrt(mse).alias("rmse"), mse.alias("mse"),
            drift_flag(F.lit(float(self.baseline_rmse)), F.sqrt(mse), self.threshold).alias("drift_detected"), "is_final",
        )

    def late_rows(self, spark: SparkSession) -> DataFrame:
        return self._all(spark, "late").drop("batch_id")

    def untimed_rows(self, spark: SparkSession) -> DataFrame:
        return self._all(spark, "untimed").drop("batch_id")
