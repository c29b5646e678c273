"""Table sinks for micro-batches (operators 5, 6, 10).

Parquet has no transactions, so replays are made harmless here: every
micro-batch writes into its own (``run_id``, ``batch_id``) partition with
dynamic partition overwrite. Re-running batch N of a query (after a failure
between the write and the checkpoint commit) replaces exactly what batch N
of that query wrote; another query, or the same job with a new checkpoint,
has another run id and never touches it.

Rows are clustered by month before they are written (``rebalance``: Spark
merges small and splits large shuffle partitions), so a batch adds about one
file per month it touches instead of one per task and month.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from fleetscope.operators.progress import running_totals
from fleetscope.operators.sketches import daily_sketches
from fleetscope.schemas import ALERT_COLUMNS, EVENT_COLUMNS


def event_month(ts: str = "event_timestamp"):
    return F.date_format(F.col(ts), "yyyy-MM")


def _write_batch(df: DataFrame, path: str, run_id: str, batch_id: int, ts: str) -> None:
    out = df.withColumns({"event_month": event_month(ts), "run_id": F.lit(str(run_id)),
                          "batch_id": F.lit(int(batch_id))})
    (out.hint("rebalance", F.col("event_month"))
     .sortWithinPartitions("event_month", "device_id", ts)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_month", "run_id", "batch_id").parquet(path))


def run_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a query's checkpoint: the same after a
    restart, another one for another checkpoint. The query must have started."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"]


# -- operator 5 ------------------------------------------------------------
def write_events_by_month(batch: DataFrame, batch_id: int, path: str,
                          extra: list[str] | None = None, run_id: str = "batch") -> None:
    """Append one micro-batch of stored-table rows, partitioned by
    event_month (pruned by time filters), run_id and batch_id (idempotent
    replay). Rows are sorted by (device_id, event_timestamp) inside each
    file, so Parquet min/max statistics serve device/time lookups."""
    extra = [c for c in (extra if extra is not None else ["ingested_at"]) if c in batch.columns]
    _write_batch(batch.select(*EVENT_COLUMNS, *extra), path, run_id, batch_id, "event_timestamp")


# -- operator 6 ------------------------------------------------------------
def write_anomaly_alerts(batch: DataFrame, batch_id: int, path: str, created_at=None,
                         run_id: str = "batch") -> None:
    """Append one micro-batch of alerts with the table's NUMERIC types, in
    the same partitions as events (event_month of the reading's time)."""
    out = batch.select(
        "device_id", "detected_at", "metric",
        F.col("observed_value").cast("decimal(10,4)").alias("observed_value"),
        F.col("rolling_mean").cast("decimal(10,4)").alias("rolling_mean"),
        F.col("rolling_std_dev").cast("decimal(10,4)").alias("rolling_std_dev"),
        F.col("z_score").cast("decimal(8,4)").alias("z_score"),
        "severity",
        (created_at if created_at is not None else F.current_timestamp()).alias("created_at"))
    _write_batch(out, path, run_id, batch_id, "detected_at")


def read_alerts(spark, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*[F.col(c).cast("double").alias(c) if c in ("observed_value", "rolling_mean",
                                                                   "rolling_std_dev", "z_score")
                       else F.col(c) for c in ALERT_COLUMNS], "created_at", "event_month", "run_id", "batch_id")


def write_daily_sketches(batch: DataFrame, batch_id: int, path: str, run_id: str = "batch") -> None:
    """Append one micro-batch's daily totals (``operators/sketches``), partitioned and replaced like the events."""
    days = daily_sketches(batch).withColumns({"event_month": F.date_format("day", "yyyy-MM"), "run_id": F.lit(str(run_id)),
                                              "batch_id": F.lit(int(batch_id))})
    (days.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_month", "run_id", "batch_id").parquet(path))


# -- operator 10 -----------------------------------------------------------
class ProgressLog(StreamingQueryListener):
    """Writes the counters of every micro-batch of the session's streaming
    queries to ``<path>/<query id>/<batch id>.json``: input rows, the
    ``observe("batch", ...)`` metrics and the devices the detector tracks.
    The files outlive the process and a replayed batch replaces its own, so
    totals (``read_progress``) neither stop after Spark's last 100 progress
    reports nor start again with the process."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        p = json.loads(event.progress.json)
        counters = (p.get("observedMetrics") or {}).get("batch", {})
        # only the keyed state of the detector's query (which counts anomalies) holds a row for each device
        keyed = [s["numRowsTotal"] for s in p.get("stateOperators") or []
                 if "GroupsWithState" in s["operatorName"] or "InPandas" in s["operatorName"]]
        row = {"query_id": p["id"], "batch_id": p["batchId"], "input_rows": p["numInputRows"],
               "devices_tracked": sum(keyed) if "anomalies" in counters else 0}
        row.update({k: v for k, v in counters.items() if isinstance(v, int)})
        jvm = self.spark.sparkContext._jvm
        file = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p['id']}/{p['batchId']}.json")
        out = file.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(file, True)
        try:
            out.write(bytearray((json.dumps(row) + "\n").encode()))
        finally:
            out.close()


def read_progress(spark: SparkSession, path: str, query_id: str, counters: list[str]) -> DataFrame:
    """The counters of one query's micro-batches with running totals
    (``total_<counter>``)."""
    fields = ["query_id string", "batch_id long", "input_rows long", "devices_tracked long"]
    schema = ", ".join(fields + [f"{c} long" for c in counters if c != "input_rows"])
    rows = spark.read.schema(schema).json(f"{path.rstrip('/')}/{query_id}").fillna(0, counters)
    return running_totals(rows, "batch_id", {c: f"total_{c}" for c in counters})
