"""The 5-minute rollup by micro-batch, late readings included (operator 27).

``rollup_5min_stream`` emits a window once and drops what comes later. Here
every micro-batch writes the additive rollup of its own readings into its
own (``event_day``, ``run_id``, ``batch_id``) partition, and readers add up
the rows of a window (``read_rollup_batches``), so a late reading corrects
its window and a replayed batch replaces what it wrote. A reading is late
when its window ended at or before the watermark: the greatest event time
of the batches before, less the delay. Late readings are counted, marked in
the rollup's rows and, if wanted, written aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.operators.rollup import ROLLUP_KEYS, finish_rollup, merge_partial_rollups, partial_rollup, window_start
from fleetscope.schemas import ROLLUP_MINUTES

CLOCK_SCHEMA = "batch_id long, max_time long, readings long, late_readings long"


class Clock:
    """Greatest event time (microseconds) and running counts after a batch: one row. Two folders take turns, so that batch N
    reads what N - 1 left and a replay of N writes over its own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def after(self, batch_id: int) -> dict:
        if batch_id < 0:
            return {"batch_id": -1, "max_time": None, "readings": 0, "late_readings": 0}
        row = self.spark.read.schema(CLOCK_SCHEMA).parquet(f"{self.path}/{batch_id % 2}").first()
        if row is None or row["batch_id"] != batch_id:
            raise ValueError(f"no clock of batch {batch_id} in {self.path}")
        return row.asDict()

    def write(self, row: dict) -> None:
        one = self.spark.createDataFrame([tuple(row[c] for c in ("batch_id", "max_time", "readings", "late_readings"))], CLOCK_SCHEMA)
        one.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{row['batch_id'] % 2}")


def is_late(start: Column, max_time: int | None, delay_minutes: int, minutes: int = ROLLUP_MINUTES) -> Column:
    """Whether a window that begins at ``start`` had ended by the watermark; before the first reading none has."""
    if max_time is None:
        return F.lit(False)
    return F.unix_micros(start) + F.lit(minutes * 60_000_000) <= F.lit(max_time - delay_minutes * 60_000_000)


def write_rollup_batch(batch: DataFrame, batch_id: int, path: str, clock: Clock, delay_minutes: int = 10,
                       run_id: str = "batch", write_late=None) -> dict:
    """Folds one micro-batch of stored-table rows (read up to three times: persist it) and returns the clock after it.
    ``write_late`` takes the late readings. A batch without rows writes no rollup and moves the clock on."""
    if delay_minutes < 0:
        raise ValueError("delay_minutes must be >= 0")
    before = clock.after(batch_id - 1)
    marked = batch.withColumn("_start", window_start()).withColumn(
        "_late", is_late(F.col("_start"), before["max_time"], delay_minutes)).drop("_start")
    n = marked.agg(F.max(F.unix_micros("event_timestamp")).alias("max_time"), F.count(F.lit(1)).alias("readings"),
                   F.count_if("_late").alias("late")).first()
    parts = partial_rollup(batch).withColumns({
        "late": is_late(F.col("window_start"), before["max_time"], delay_minutes),
        "event_day": F.date_format("window_start", "yyyy-MM-dd"), "run_id": F.lit(str(run_id)), "batch_id": F.lit(int(batch_id))})
    (parts.hint("rebalance", F.col("event_day")).sortWithinPartitions("event_day", "device_id", "window_start")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_day", "run_id", "batch_id").parquet(path))
    if write_late is not None and n["late"]:
        write_late(marked.where("_late").drop("_late"), batch_id)
    times = [t for t in (before["max_time"], n["max_time"]) if t is not None]
    after = {"batch_id": batch_id, "max_time": max(times, default=None), "readings": before["readings"] + n["readings"],
             "late_readings": before["late_readings"] + n["late"]}
    clock.write(after)
    return after


def read_rollup_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rollup over all batches: one row per window, as ``rollup_5min`` over all readings gives it."""
    return finish_rollup(merge_partial_rollups(spark.read.parquet(path)))


def late_windows(spark: SparkSession, path: str) -> DataFrame:
    """Windows that late readings have corrected, with the number of these readings."""
    return (spark.read.parquet(path).where("late").groupBy(*ROLLUP_KEYS)
            .agg(F.sum("event_count").alias("late_readings")))
