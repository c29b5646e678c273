"""Anomaly detection by micro-batch, a device's readings cut over tasks (operator 20).

The keyed-state detector (detect_stream.py) hands all of a device's readings in one micro-batch to one call. Here a
micro-batch is scored by the batch operator instead: its readings are numbered in blocks (blocks.py), and the last
``window - 1`` readings that each device and metric had before, the *tail*, are put in front of the device's first block.
Every task holds about ``target_rows`` readings, however many of them one device sends.

Tails are kept as versions, one for each micro-batch (``TailTable``). Batch N reads versions below N only and overwrites
version N, so a replayed batch gives the same alerts and the same tail. A version holds the devices of its batch; every
``full_every`` batches it holds all devices, and older ones are removed when the next batch starts.

Readings are applied in the order in which micro-batches arrive and by ``order_cols`` within one, late ones on arrival.
Rows without a device are left out. Metrics that are null take no place in a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetscope.operators.blocks import DEFAULT_TARGET_ROWS, assign_blocks
from fleetscope.operators.detect import score_blocked, unpivot_metrics
from fleetscope.schemas import MONITORED_METRICS, THRESHOLDS, WINDOW_SIZE

BATCH, VERSION = "_batch", "_version"


def latest(tail: DataFrame, device_col: str = "device_id") -> DataFrame:
    """The rows of each device's highest version."""
    top = F.max(VERSION).over(Window.partitionBy(device_col))
    return tail.withColumn("_top", top).where(F.col(VERSION) == F.col("_top")).drop("_top", VERSION)


def last_readings(rows: DataFrame, device_col: str, order: list[str], metrics: list[str], window: int) -> DataFrame:
    """(device, metric, order columns, x): the last ``window - 1`` readings of each device and metric. ``rows`` have
    ``_blk``: the last ones of each block are found first, so that no task sees more of a device than one block or the
    ends of its blocks."""
    long = unpivot_metrics(rows, [device_col, *order, "_blk"], metrics)
    for keys in ([device_col, "metric", "_blk"], [device_col, "metric"]):
        back = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
        long = long.withColumn("_back", F.row_number().over(back)).where(F.col("_back") < window).drop("_back")
    return long.drop("_blk")


def detect_batch(batch: DataFrame, tail: DataFrame | None, batch_id: int, *, device_col: str = "device_id",
                 time_col: str = "event_timestamp", order_cols: list[str] | None = None,
                 metrics: list[str] = MONITORED_METRICS, thresholds: dict | DataFrame = THRESHOLDS,
                 window: int = WINDOW_SIZE, exact: bool = True, scale: int = 100,
                 target_rows: int = DEFAULT_TARGET_ROWS, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(alerts of the batch's readings, new tail of the batch's devices). ``tail``: versions of tails before the batch, or
    None. ``batch`` is read several times."""
    order_cols, keep = order_cols or [time_col, "event_id"], keep or []
    order = [BATCH, *order_cols]
    carry = list(dict.fromkeys([*order_cols, time_col, *keep]))
    new = batch.where(F.col(device_col).isNotNull()).select(
        device_col, *carry, F.lit(batch_id).cast("long").alias(BATCH), *[F.col(m).cast("double").alias(m) for m in metrics])
    rows = assign_blocks(new, [device_col], order_cols, target_rows)
    if tail is not None:
        devices = rows.groupBy(device_col).agg(F.max("_split").alias("_split"))
        before = latest(tail.join(devices, device_col), device_col).select(
            device_col, *order, *[F.when(F.col("metric") == m, F.col("x")).alias(m) for m in metrics],
            F.lit(0).cast("long").alias("_blk"), "_split")
        rows = rows.unionByName(before, allowMissingColumns=True)
    rows = rows.repartition(device_col, "_blk")
    alerts = score_blocked(rows, device_col=device_col, time_col=time_col, order_cols=order, metrics=metrics,
                           thresholds=thresholds, window=window, exact=exact, scale=scale, keep=[*keep, BATCH])
    return (alerts.where(F.col(BATCH) == batch_id).drop(BATCH),
            last_readings(rows, device_col, order, metrics, window))


class TailTable:
    """Versions of tails below ``path``: ``part-N`` has the devices of batch N, ``full-N`` all devices after it."""

    def __init__(self, spark: SparkSession, path: str, device_col: str = "device_id", full_every: int = 32):
        if full_every < 1:
            raise ValueError("full_every must be >= 1")
        self.spark, self.path, self.device_col, self.full_every = spark, path.rstrip("/"), device_col, full_every

    def _folder(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p, jvm

    def versions(self, before: int) -> list[tuple[int, str]]:
        """(batch, kind) of the versions that make up the tails before a batch, oldest first."""
        fs, p, _ = self._folder()
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        found = sorted((int(n.split("-")[1]), n.split("-")[0]) for n in names if n.split("-")[0] in ("part", "full"))
        found = [v for v in found if v[0] < before]
        start = max((b for b, kind in found if kind == "full"), default=-1)
        return [v for v in found if v[0] >= start]

    def read(self, before: int) -> DataFrame | None:
        paths = [f"{self.path}/{kind}-{b}" for b, kind in self.versions(before)]
        return self.spark.read.parquet(*paths) if paths else None

    def write(self, tail: DataFrame, batch_id: int) -> None:
        """``tail``: of the batch's devices. Overwrites what an earlier run of this batch wrote."""
        known = self.versions(batch_id)
        full = not known or len(known) >= self.full_every
        version = F.lit(batch_id).cast("long").alias(VERSION)
        if full and known:
            old = self.read(batch_id)
            there = tail.select(self.device_col).distinct()
            tail = tail.unionByName(latest(old.join(there, self.device_col, "left_anti"), self.device_col))
        tail.select("*", version).write.mode("overwrite").parquet(f"{self.path}/{'full' if full else 'part'}-{batch_id}")

    def drop_unused(self, before: int) -> None:
        """Removes versions that no batch from ``before`` on reads (the batches below it are committed)."""
        used = self.versions(before)
        fs, p, jvm = self._folder()
        if not used:
            return
        for f in fs.listStatus(p):
            kind, _, number = f.getPath().getName().partition("-")
            if kind in ("part", "full") and int(number) < used[0][0]:
                fs.delete(f.getPath(), True)
