"""Keyed message streams: source, decode and encode (operators 1, 2, 7).

Messages have the shape of Spark's Kafka source: ``key``, ``value``
(binary), ``topic``, ``partition``, ``offset``, ``timestamp``. The same
shape can be read from files (JSON lines with the value as text), which is
what tests use: no broker is started here and no Kafka jar is installed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.functions.expressions import iso_text
from fleetscope.schemas import NUMERIC_FIELDS, TEXT_FIELDS, WIRE_EVENT_SCHEMA

CORRUPT = "_corrupt"
_MARK = "_mark"
_DECODE_SCHEMA = T.StructType([
    T.StructField("m", T.ArrayType(T.StructType(list(WIRE_EVENT_SCHEMA.fields) + [T.StructField(_MARK, T.StringType())]))),
    T.StructField(CORRUPT, T.StringType())])

# Message files: one JSON object per line; value is the message text.
MESSAGE_FILE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


# -- operator 1 ------------------------------------------------------------
def telemetry_source(spark: SparkSession, *, topic: str = "device-telemetry",
                     bootstrap: str | None = None, path: str | None = None,
                     max_offsets_per_trigger: int | None = None,
                     options: dict | None = None) -> DataFrame:
    """Streaming messages from the earliest position.

    With ``bootstrap`` it subscribes to a Kafka topic (needs the Kafka
    connector on the classpath); progress is committed by the query's
    checkpoint only after the sink has written the batch. With ``path`` it
    reads message files of the same columns.
    """
    opts = dict(options or {})
    if bootstrap:
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", bootstrap)
                  .option("subscribe", topic)
                  .option("startingOffsets", "earliest"))  # lost offsets fail the query (Spark's default)
        if max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        for k, v in opts.items():
            reader = reader.option(k, v)
        return reader.load()
    if not path:
        raise ValueError("telemetry_source needs bootstrap (Kafka) or path (message files)")
    reader = spark.readStream.schema(MESSAGE_FILE_SCHEMA)
    for k, v in opts.items():  # e.g. maxFilesPerTrigger to cap a micro-batch
        reader = reader.option(k, v)
    return as_messages(reader.json(path))


def as_messages(files: DataFrame) -> DataFrame:
    return files.select(F.col("key").cast("binary").alias("key"),
                        F.col("value").cast("binary").alias("value"),
                        "topic", "partition", "offset", "timestamp")


# -- operator 2 ------------------------------------------------------------
def decode_telemetry(messages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """UTF-8 + JSON decode of ``value`` into the wire event fields.

    Malformed messages are kept, not fatal: ``_corrupt`` holds their text
    (or "<invalid utf-8>"); ``_not_object`` marks text that is not one JSON
    object (an array, a number, a second object or trailing data after the
    object, which ``from_json`` alone would ignore). Quarantine decides what
    happens to them.

    One parse does both: the text is read as the middle of three array
    elements, between two marks that hold its SHA-256. Text that closes the
    array or object around it early, or adds elements, either is no JSON or
    loses a mark, and cannot hold its own digest to replace it.
    """
    keep = keep if keep is not None else [c for c in ("key", "partition", "offset")
                                          if c in messages.columns]
    text = F.when(F.is_valid_utf8(F.col("value")), F.col("value").cast("string"))
    mark = F.sha2(F.col("value"), 256)
    ends = F.concat(F.lit(f'{{"{_MARK}":"'), mark, F.lit('"}'))
    parsed = F.from_json(F.concat(F.lit('{"m":['), ends, F.lit(","), text, F.lit(","), ends, F.lit("]}")), _DECODE_SCHEMA,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # Parse once per message (a projection) ...
    once = messages.select(*keep, text.alias("_text"), mark.alias("_sha"), parsed.alias("_e"))
    body = F.col("_text")
    at = lambda i: F.get(F.col("_e.m"), F.lit(i))
    # its parts taken out once too: written out in each field, they make a method that the JVM does not compile
    once = once.select("*", at(1).alias("_one"), F.size("_e.m").alias("_n"), at(0)[_MARK].alias("_m0"), at(2)[_MARK].alias("_m2"))
    corrupt = (F.when(body.isNull(), F.lit("<invalid utf-8>"))
               .when(F.col(f"_e.{CORRUPT}").isNotNull(), body))
    one_object = (F.btrim(body, F.lit(" \t\r\n")).startswith("{") & (F.col("_n") == 3)
                  & F.col("_m0").eqNullSafe(F.col("_sha")) & F.col("_m2").eqNullSafe(F.col("_sha")))
    decoded = F.struct(
        *[F.col("_one")[f.name].alias(f.name) for f in WIRE_EVENT_SCHEMA.fields],
        corrupt.alias(CORRUPT),
        (body.isNotNull() & ~F.coalesce(one_object, F.lit(False))).alias("_not_object"))
    # ... then inline(array(x)), exactly one row per message. As a Generate
    # it is a barrier: filters on decoded fields (quarantine) are not pushed
    # below it, so the parse is never copied into each check.
    return once.select(*keep, F.inline(F.array(decoded)))


# -- encode (wire form of readings; also operator 7 for alerts) -----------
def encode_events(events: DataFrame, topic: str = "device-telemetry", partitions: int = 6,
                  offset_col: str = "event_id", null_fields: bool = False) -> DataFrame:
    """Stored-table rows -> keyed JSON messages (key = device_id). Null
    fields are left out, or written as null with ``null_fields``.

    The partition is a hash of the key, so all readings of a device share
    one partition; ``offset_col`` must grow in arrival order per device.
    """
    body = F.to_json(F.struct(
        *[F.col(c) for c in TEXT_FIELDS],
        iso_text(F.col("event_timestamp")).alias("timestamp"),
        *[F.col(c).cast("double").alias(c) for c in NUMERIC_FIELDS],
        F.col("event_type")), {"ignoreNullFields": "false" if null_fields else "true"})
    return events.select(
        F.col("device_id").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.hash("device_id"), F.lit(partitions)).alias("partition"),
        F.col(offset_col).cast("long").alias("offset"))


def publish_alerts(alerts: DataFrame, topic: str = "device-anomalies") -> DataFrame:
    """Alert rows -> messages: key = device_id, value = JSON with the
    object names (timestamp, mean, std_dev). Write with
    ``writeStream.format("kafka")`` or any sink taking key/value."""
    body = F.to_json(F.struct(
        F.col("device_id"),
        iso_text(F.col("detected_at")).alias("timestamp"),
        F.col("metric"),
        F.col("observed_value").cast("double").alias("observed_value"),
        F.col("rolling_mean").cast("double").alias("mean"),
        F.col("rolling_std_dev").cast("double").alias("std_dev"),
        F.col("z_score").cast("double").alias("z_score"),
        F.col("severity")))
    return alerts.select(F.col("device_id").cast("binary").alias("key"),
                         body.cast("binary").alias("value"),
                         F.lit(topic).alias("topic"))


ALERT_WIRE_SCHEMA = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("observed_value", T.DoubleType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("std_dev", T.DoubleType()),
    T.StructField("z_score", T.DoubleType()),
    T.StructField("severity", T.StringType()),
])


def decode_alerts(messages: DataFrame) -> DataFrame:
    a = F.from_json(F.col("value").cast("string"), ALERT_WIRE_SCHEMA)
    return messages.select(F.col("key").cast("string").alias("key"), a.alias("a")).select("key", "a.*")


def write_alert_messages(messages: DataFrame, batch_id: int, *, path: str | None = None,
                         bootstrap: str | None = None, topic: str = "device-anomalies",
                         options: dict | None = None) -> None:
    """Publish one micro-batch of alert messages to a Kafka topic
    (``bootstrap``, at least once) or to JSON files, where a replayed batch
    replaces itself (``path``)."""
    if bootstrap:
        w = (messages.select("key", "value").write.format("kafka")
             .option("kafka.bootstrap.servers", bootstrap).option("topic", topic))
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.save()
    elif path:
        (messages.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic",
                         F.lit(int(batch_id)).alias("batch_id"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").json(path))
    else:
        raise ValueError("publishing needs bootstrap (Kafka) or path (message files)")
