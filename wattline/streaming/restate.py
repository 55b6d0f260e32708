"""Forward fill on a stream whose readings may come late.

Each meter has a buffer of the readings of its last ``lateness_seconds``, and the value that was last present before them. A reading that falls into the buffer
is put in its place, and the readings behind it whose filled value changes are restated: they are written again under the newer batch. A result takes the
newest statement of each reading, so it equals the batch operator's over all readings, in whatever order they came within the bound. Readings from
before the buffer, and those without a timestamp, go to tables of their own. Every write is keyed by the batch id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattline.functions.calendar import MICROS_PER_SECOND, wall_micros
from wattline.operators.impute import forward_fill
from wattline.operators.ordered import CHUNK_DAYS, CHUNK_ROWS
from wattline.storage import attach, materialize, remove, scratch_path

_ROW, _FILLED = "_row", "_filled"


@dataclass(frozen=True)
class RestatedFill:
    """Paths and columns of one run. Readings that agree in timestamp and tie-break stay in the order of their arrival."""

    base: str
    lateness_seconds: int
    key: str = "meter_id"
    ts: str = "timestamp"
    value: str = "value"
    tie: str | None = None
    chunk_days: int = CHUNK_DAYS
    chunk_rows: int = CHUNK_ROWS

    def _part(self, table: str, batch_id: int) -> str:
        return f"{self.base}/{table}/batch_id={batch_id}"

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        key, ts, value, columns = self.key, self.ts, self.value, batch.columns
        numbered = batch.withColumn(_ROW, F.lit(batch_id << 40) + F.monotonically_increasing_id())
        arrived = materialize(numbered, "restate-batch")
        arrived.where(F.col(ts).isNull()).select(*columns).write.mode("overwrite").parquet(self._part("untimed", batch_id))
        fresh = arrived.where(F.col(ts).isNotNull()).withColumn(_FILLED, F.lit(None).cast("double")).withColumn("_new", F.lit(True))
        carry_schema = f"_key {batch.schema[key].dataType.simpleString()}, _newest long, _carry double"
        if batch_id:
            carry = spark.read.schema(carry_schema).parquet(self._part("carry", batch_id - 1))
            buffer = spark.read.schema(fresh.drop("_new").schema).parquet(self._part("buffer", batch_id - 1)).withColumn("_new", F.lit(False))
        else:
            carry = spark.createDataFrame([], carry_schema)
            buffer = fresh.limit(0)
        bound = F.col("_newest") - self.lateness_seconds * MICROS_PER_SECOND
        at = wall_micros(F.col(ts))
        by_key = carry.withColumnRenamed("_key", key)
        known = attach(fresh, by_key, [key], [_ROW])
        too_late = F.coalesce(at < bound, F.lit(False))
        known.where(too_late).select(*columns).write.mode("overwrite").parquet(self._part("late", batch_id))
        # meters without a new reading keep their buffer as it is
        touched = fresh.select(F.col(key).alias("_key")).distinct()
        same = F.col(key).eqNullSafe(F.col("_key"))
        timely = known.where(~too_late).select(*fresh.columns)
        rows = materialize(timely.unionByName(buffer.join(touched, same, "left_semi")), "restate-rows")
        # a reading is filled under a copy of its value, as the reading itself is kept
        order = F.struct(*([F.col(self.tie).cast("long")] if self.tie else []), F.col(_ROW))
        place = F.struct(at.alias("at"), order.alias("order"))
        tied = self._tied(rows)
        filled = forward_fill(tied.withColumn("_now", F.col(value).cast("double")), ["_now"], [key], ts, "_tie", self.chunk_days, self.chunk_rows)
        filled = attach(filled, by_key, [key], [_ROW]).withColumn("_now", F.coalesce("_now", "_carry"))
        filled = materialize(filled, "restate-filled")
        changed = F.col("_new") | ~F.col("_now").eqNullSafe(F.col(_FILLED))
        stated = [F.col("_now").alias(value) if c == value else F.col(c) for c in columns]
        filled.where(changed).select(*stated, _ROW).write.mode("overwrite").parquet(self._part("filled", batch_id))
        newest = filled.groupBy(key).agg(F.max(at).alias("_seen"), F.max("_newest").alias("_before"))
        newest = newest.select(key, F.greatest("_seen", "_before").alias("_top"))
        edge = F.col("_top") - self.lateness_seconds * MICROS_PER_SECOND
        topped = attach(filled, newest, [key], [_ROW])
        behind = topped.groupBy(key).agg(
            F.max("_top").alias("_newest"), F.max_by("_now", F.when(at < edge, place)).alias("_last"), F.max("_carry").alias("_old"), F.count_if(at < edge).alias("_left")
        )
        # with rows left behind their last filled value holds what was carried before
        moved = behind.select(F.col(key).alias("_key"), "_newest", F.when(F.col("_left") > 0, F.col("_last")).otherwise(F.col("_old")).alias("_carry"))
        seen = moved.select(F.col("_key").alias("_of"))
        kept = carry.join(seen, F.col("_key").eqNullSafe(F.col("_of")), "left_anti")
        kept.unionByName(moved).write.mode("overwrite").parquet(self._part("carry", batch_id))
        held = topped.where(at >= edge).select(*columns, _ROW, F.col("_now").alias(_FILLED))
        still = buffer.join(touched, same, "left_anti").select(*columns, _ROW, _FILLED)
        held.unionByName(still).write.mode("overwrite").parquet(self._part("buffer", batch_id))
        for table in ("carry", "buffer"):
            remove(spark, self._part(table, batch_id - 2))

    def _tied(self, rows: DataFrame) -> DataFrame:
        """With one number that orders readings of one timestamp: the tie-break, or the order of arrival."""
        return rows.withColumn("_tie", F.col(self.tie).cast("long") if self.tie else F.col(_ROW))

    def start(self, stream: DataFrame, available_now: bool = True) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", f"{self.base}/checkpoint")
        return writer.trigger(availableNow=True).start() if available_now else writer.start()

    def result(self, spark: SparkSession) -> DataFrame:
        """Every reading once, with the value of its newest statement."""
        stated = spark.read.parquet(f"{self.base}/filled")
        columns = [c for c in stated.columns if c not in (_ROW, "batch_id")]
        newest = F.max_by(F.struct(*columns), "batch_id").alias("row")
        return stated.groupBy(_ROW).agg(newest).select("row.*")

    def restated(self, spark: SparkSession) -> DataFrame:
        """How often each reading was stated, for those stated more than once."""
        return spark.read.parquet(f"{self.base}/filled").groupBy(_ROW).agg(F.count(F.lit(1)).alias("times")).where("times > 1")

    def late_rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.base}/late").drop("batch_id")

    def untimed_rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.base}/untimed").drop("batch_id")
