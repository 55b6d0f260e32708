"""Forward fill on a stream of long readings.

State is one row per meter: the place of its last reading (timestamp and tie-break) and its last present value. It lives
in a table version per micro-batch; the last two versions are kept. A batch is filled by the batch operator, so a meter that has a third
of the rows is cut into chunks here as well, instead of passing through one state function.
Every write is keyed by the batch id: a batch that runs again after a failure replaces its
own output and state and nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattline.operators.impute import forward_fill
from wattline.operators.ordered import CHUNK_DAYS, CHUNK_ROWS
from wattline.operators.timed import rejected_rows, timed
from wattline.storage import attach, remove, scratch_path


@dataclass(frozen=True)
class StreamFill:
    """Paths and columns of one streaming fill."""

    base: str
    key: str = "meter_id"
    ts: str = "timestamp"
    value: str = "value"
    tie: str | None = None
    chunk_days: int = CHUNK_DAYS
    chunk_rows: int = CHUNK_ROWS

    @property
    def filled(self) -> str:
        return f"{self.base}/filled"

    @property
    def late(self) -> str:
        return f"{self.base}/late"

    @property
    def untimed(self) -> str:
        return f"{self.base}/untimed"

    def state(self, batch_id: int) -> str:
        return f"{self.base}/state/batch_id={batch_id}"

    def _previous(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        try:
            return spark.read.parquet(self.state(batch_id - 1))
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error) or batch_id > 0:
                raise
            return None

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        key, ts, value = self.key, self.ts, self.value
        columns = batch.columns
        state = self._previous(spark, batch_id)
        # The batch is needed several times; on shared storage it survives the loss of an executor.
        held = scratch_path(spark, "stream-batch")
        batch.write.parquet(held)
        arrived = spark.read.schema(batch.schema).parquet(held)
        rejected_rows(arrived, ts).write.mode("overwrite").parquet(f"{self.untimed}/batch_id={batch_id}")
        rows = timed(arrived, "reject", ts)
        if state is None:
            known = rows.withColumns(
                {
                    "_last_ts": F.lit(None).cast(rows.schema[ts].dataType),
                    "_last_tie": F.lit(None).cast("bigint"),
                    "_last_value": F.lit(None).cast("double"),
                }
            )
        else:
            known = attach(rows, state, [key], [ts])
        tie = F.col(self.tie).cast("bigint") if self.tie else F.lit(0).cast("bigint")
        behind = (F.col(ts) < F.col("_last_ts")) | ((F.col(ts) == F.col("_last_ts")) & (tie < F.col("_last_tie")))
        is_late = F.coalesce(behind, F.lit(False))
        known.where(is_late).select(*columns).write.mode("overwrite").parquet(f"{self.late}/batch_id={batch_id}")
        in_time = known.where(~is_late)
        filled = forward_fill(in_time, [value], [key], ts, self.tie, self.chunk_days, self.chunk_rows)
        filled.select(
            *[F.coalesce(F.col(value), F.col("_last_value")).alias(value) if c == value else F.col(c) for c in columns]
        ).write.mode("overwrite").parquet(f"{self.filled}/batch_id={batch_id}")

        place = F.struct(F.col(ts).alias("ts"), tie.alias("tie"))
        newest = in_time.groupBy(key).agg(
            F.max(place).alias("_last"),
            F.max_by(value, F.when(F.col(value).isNotNull(), place)).cast("double").alias("_last_value"),
        )
        newest = newest.select(key, F.col("_last.ts").alias("_last_ts"), F.col("_last.tie").alias("_last_tie"), "_last_value")
        if state is not None:
            both = state.withColumn("_age", F.lit(0)).unionByName(newest.withColumn("_age", F.lit(1)))
            last = F.max(F.struct("_last_ts", "_last_tie"))
            newest = both.groupBy(key).agg(
                last.alias("_last"), F.max_by("_last_value", F.when(F.col("_last_value").isNotNull(), F.col("_age"))).alias("_last_value")
            )
            newest = newest.select(key, "_last._last_ts", "_last._last_tie", "_last_value")
        newest.write.mode("overwrite").parquet(self.state(batch_id))
        # a repeated batch needs the state before it, and none older
        remove(spark, self.state(batch_id - 2))
        remove(spark, held)

    def start(self, stream: DataFrame, available_now: bool = True) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", f"{self.base}/checkpoint")
        return writer.trigger(availableNow=True).start() if available_now else writer.start()

    def result(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.filled).drop("batch_id")

    def late_rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.late).drop("batch_id")

    def untimed_rows(self, spark: SparkSession) -> DataFrame:
        """Readings without a timestamp, which have no place in a series."""
        return spark.read.parquet(self.untimed).drop("batch_id")
