"""Streaming queries of the ingest path (operators 1, 5, 6, 8, 20, 27).

One keyed message source feeds independent streaming queries, each with
its own checkpoint (Spark's unit of exactly-once progress):

* events:     decode -> quarantine (valid) -> conform -> once -> stored events
* quarantine: decode -> quarantine (rejected) -> rejected messages with reasons
* alerts:     decode -> readable (device, time) -> dedup -> keyed state -> stored and published alerts
* alerts of hot devices: decode -> readable -> once -> batch detection with tails -> stored and published alerts
* rollup:     decode -> quarantine (valid) -> conform -> once -> 5-minute windows

A micro-batch is written before its offsets are committed, so after a
failure the batch is replayed; the sinks overwrite their own batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.operators.blocks import DEFAULT_TARGET_ROWS
from fleetscope.operators.ingest import (conform_event, dedup_events, detector_readings, quarantine_invalid,
                                         split_valid, stamp_ingest_time)
from fleetscope.schemas import WINDOW_SIZE
from fleetscope.sources.messages import (decode_telemetry, publish_alerts, telemetry_source,
                                         write_alert_messages)
from fleetscope.streaming.detect_batches import TailTable, detect_batch
from fleetscope.streaming.detect_stream import detect_anomalies_stream
from fleetscope.streaming.insert_once import insert_once
from fleetscope.streaming.rollup_batches import Clock, write_rollup_batch
from fleetscope.streaming.rollup_stream import rollup_5min_stream
from fleetscope.streaming.sinks import run_id_of, write_anomaly_alerts, write_events_by_month

# Redelivery horizon of the alerts query, on the time of the micro-batch. (Spark allows one keyed
# Python state in a query, and there it is the detector's; the other queries know no horizon.)
ALERTS_HORIZON = "1 hour"
DEFAULT_INTERVAL = "1 minute"  # a batch folder a minute
# A micro-batch is bounded, also when a long backlog is read.
MAX_OFFSETS_PER_TRIGGER = 5_000_000
MAX_FILES_PER_TRIGGER = "64"


class _start_conf:
    """Session settings read when a streaming query starts (and then kept
    in its checkpoint); restored on the session afterwards."""

    def __init__(self, spark: SparkSession, conf: dict):
        self.spark, self.conf = spark, conf

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k, None) for k in self.conf}
        for k, v in self.conf.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


# Queries whose output does not wait for a watermark need no micro-batch
# without data.
_NO_EMPTY_BATCHES = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}


def decoded_messages(spark: SparkSession, source: dict, arrival: Column | None = None) -> DataFrame:
    """Decoded messages with their key and source position, and ``arrival`` as ``_arrival``."""
    source = dict(source)
    if source.get("bootstrap"):
        source.setdefault("max_offsets_per_trigger", MAX_OFFSETS_PER_TRIGGER)
    else:
        source["options"] = {"maxFilesPerTrigger": MAX_FILES_PER_TRIGGER, **(source.get("options") or {})}
    messages, keep = telemetry_source(spark, **source), ["key", "partition", "offset"]
    if arrival is not None:
        messages, keep = messages.withColumn("_arrival", arrival), [*keep, "_arrival"]
    return decode_telemetry(messages, keep=keep)


def valid_readings(spark: SparkSession, source: dict) -> DataFrame:
    """Stored-table rows of the valid messages, each once, with the source
    position. Readings that are late by event time are kept and processed on
    arrival, as the reference does."""
    valid, _ = split_valid(quarantine_invalid(decoded_messages(spark, source)))
    return insert_once(conform_event(valid, keep=["partition", "offset"]))


def _trigger(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval or DEFAULT_INTERVAL)


class _run_id:
    """The query's run id, read from its checkpoint with the first batch."""

    def __init__(self, checkpoint: str):
        self.checkpoint, self.value = checkpoint, None

    def __call__(self, spark: SparkSession) -> str:
        if self.value is None:
            self.value = run_id_of(spark, self.checkpoint)
        return self.value


def start_events_query(spark, source: dict, events_path: str, checkpoint: str,
                       available_now: bool = True, interval: str | None = None, ingested_at=None):
    rows = stamp_ingest_time(valid_readings(spark, source), at=ingested_at)
    # per-batch counters (operator 10) reported in the query's progress
    rows = rows.observe("batch", F.count(F.lit(1)).alias("events"),
                        F.count_if(F.col("event_type") == "critical").alias("critical"))

    run_id = _run_id(checkpoint)

    def sink(batch: DataFrame, batch_id: int):
        write_events_by_month(batch, batch_id, events_path, extra=["ingested_at", "partition", "offset"],
                              run_id=run_id(batch.sparkSession))

    w = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    with _start_conf(spark, _NO_EMPTY_BATCHES):
        return _trigger(w, available_now, interval).start()


def start_quarantine_query(spark, source: dict, path: str, checkpoint: str,
                           available_now: bool = True, interval: str | None = None):
    _, rejected = split_valid(quarantine_invalid(decoded_messages(spark, source)))
    out = rejected.select("partition", "offset", F.col("key").cast("string").alias("key"),
                          F.concat_ws(",", "reject_reasons").alias("reasons"),
                          F.col("_corrupt").alias("raw_text"))
    w = (out.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return _trigger(w, available_now, interval).start()


def start_alerts_query(spark, source: dict, alerts_path: str, checkpoint: str,
                       available_now: bool = True, interval: str | None = None,
                       window: int = 60, state_timeout: str | None = None, created_at=None,
                       publish: dict | None = None):
    """Alerts of all readable readings -> the alert table and, with
    ``publish`` (the arguments of ``write_alert_messages``), a topic or
    message files."""
    # on the time of the micro-batch, never on the broker's timestamps: no message is late when it is first seen
    arrived = decoded_messages(spark, source, F.current_timestamp())
    rows = detector_readings(arrived, keep=["partition", "offset", "_arrival"]).withWatermark("_arrival", ALERTS_HORIZON)
    rows = dedup_events(rows, ["partition", "offset"], watermark_col="_arrival").drop("_arrival")
    alerts = detect_anomalies_stream(rows, order_cols=["offset"], window=window,
                                     state_timeout=state_timeout, keep=["offset"])
    alerts = alerts.observe("batch", F.count(F.lit(1)).alias("anomalies"),
                            F.count_if(F.col("severity") == "critical").alias("critical"))
    run_id = _run_id(checkpoint)

    def sink(batch: DataFrame, batch_id: int):
        if publish:
            batch = batch.persist()  # read by two writers
        write_anomaly_alerts(batch, batch_id, alerts_path, created_at=created_at, run_id=run_id(batch.sparkSession))
        if publish:
            write_alert_messages(publish_alerts(batch), batch_id, **publish)
            batch.unpersist()

    w = alerts.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    with _start_conf(spark, _NO_EMPTY_BATCHES):
        return _trigger(w, available_now, interval).start()


def start_split_alerts_query(spark, source: dict, alerts_path: str, checkpoint: str, available_now: bool = True,
                             interval: str | None = None, window: int = WINDOW_SIZE, created_at=None,
                             publish: dict | None = None, target_rows: int = DEFAULT_TARGET_ROWS, full_every: int = 32):
    """The alerts query for streams in which one device may send much of a micro-batch: its readings are cut over tasks
    (``detect_batch``). The detector keeps no Spark state, so messages are known by ``insert_once``, without a horizon."""
    rows = insert_once(detector_readings(decoded_messages(spark, source), keep=["partition", "offset"]))
    run_id, tails = _run_id(checkpoint), TailTable(spark, f"{checkpoint.rstrip('/')}/_tails", full_every=full_every)

    def sink(batch: DataFrame, batch_id: int):
        batch = batch.persist()  # read by the blocks, the alerts and the tail
        try:
            tails.drop_unused(batch_id)
            alerts, tail = detect_batch(batch, tails.read(batch_id), batch_id, order_cols=["offset"], window=window,
                                        target_rows=target_rows, keep=["offset"])
            write_anomaly_alerts(alerts, batch_id, alerts_path, created_at=created_at, run_id=run_id(batch.sparkSession))
            if publish:
                write_alert_messages(publish_alerts(alerts), batch_id, **publish)
            tails.write(tail, batch_id)
        finally:
            batch.unpersist()

    w = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    with _start_conf(spark, _NO_EMPTY_BATCHES):
        return _trigger(w, available_now, interval).start()


def start_rollup_query(spark, source: dict, path: str, checkpoint: str, delay: str = "10 minutes",
                       available_now: bool = True, interval: str | None = None):
    """Windows of the valid readings, each message counted once, however
    late it is delivered again."""
    out = rollup_5min_stream(valid_readings(spark, source), delay=delay)
    w = (out.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return _trigger(w, available_now, interval).start()


def start_late_rollup_query(spark, source: dict, path: str, checkpoint: str, late_path: str | None = None,
                            delay_minutes: int = 10, available_now: bool = True, interval: str | None = None):
    """The rollup with late readings folded into their windows (``rollup_batches``); they are counted, and written to
    ``late_path`` as stored events."""
    run_id, clock = _run_id(checkpoint), Clock(spark, f"{checkpoint.rstrip('/')}/_clock")

    def sink(batch: DataFrame, batch_id: int):
        batch, run = batch.persist(), run_id(batch.sparkSession)
        try:
            write_late = late_path and (lambda rows, n: write_events_by_month(
                rows, n, late_path, extra=["partition", "offset"], run_id=run))
            write_rollup_batch(batch, batch_id, path, clock, delay_minutes, run_id=run, write_late=write_late)
        finally:
            batch.unpersist()

    w = valid_readings(spark, source).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    with _start_conf(spark, _NO_EMPTY_BATCHES):
        return _trigger(w, available_now, interval).start()


def run_to_end(query) -> None:
    """Wait for an availableNow query and surface its failure, if any."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
