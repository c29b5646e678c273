"""Telemetry inputs derived from the given test tables.

``telemetry_view`` turns ``events`` into device readings (one device per
user); ``lineitem_history`` turns ``lineitem`` into a long per-supplier
history. Both are plain projections, so they scale with their tables and
Catalyst prunes the scan to the columns they use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The view of FIXTURES.md §2 (Spark dialect). Readings are 2-decimal by
# contract; about 2 % carry an injected spike (j = event_id % 150).
_VIEW_EXPRS = [
    "event_id",
    "concat('DEV-', lpad(cast(user_id AS string), 5, '0')) AS device_id",
    "concat('tracker-', chr(97 + user_id % 7)) AS model",
    "concat('v', cast(10 + user_id % 6 AS string), '.', cast(user_id % 10 AS string), '.0') AS firmware",
    "CASE WHEN user_id % 3 = 0 THEN 'wifi' ELSE 'mesh' END AS network_type",
    "ts AS event_timestamp",
    "cast(CASE WHEN j = 0 THEN 95 WHEN j = 75 THEN 75 ELSE 20 + (k * 25) / 100.0 END AS decimal(5,2)) AS cpu_usage_pct",
    "cast(40 + ((event_id * 131) % 2501) / 100.0 AS decimal(5,2)) AS memory_usage_pct",
    "cast(CASE WHEN j = 50 THEN -112 ELSE -82 + ((event_id * 37) % 2001) / 100.0 END AS decimal(6,2)) AS signal_strength_dbm",
    "cast(CASE WHEN j = 50 THEN 5 WHEN j = 100 THEN 2 ELSE 160 + least(value, 800.0) END AS decimal(8,2)) AS throughput_mbps",
    "cast(20 + (event_id * 13) % 81 AS decimal(5,2)) AS battery_pct",
]

_EVENT_TYPE_EXPR = (
    "CASE WHEN cpu_usage_pct > 85 OR signal_strength_dbm < -105 OR throughput_mbps < 10 THEN 'critical' "
    "WHEN cpu_usage_pct > 70 OR signal_strength_dbm < -90 OR throughput_mbps < 50 THEN 'degraded' "
    "ELSE 'normal' END AS event_type"
)


def telemetry_view(events: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """events -> one stored-table row per reading (decimal metrics, NTZ time).
    ``carry`` passes extra input columns through unchanged."""
    carry = carry or []
    e = events.select(
        "event_id", "user_id", "ts", "value", *carry,
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.col("event_id") % 150).alias("j"),
    )
    return e.selectExpr(*_VIEW_EXPRS, *carry).selectExpr("*", _EVENT_TYPE_EXPR)


def load_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_view(load_table(spark, sf_dir, "events"))


LINEITEM_METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEITEM_THRESHOLDS = {m: (1.8, 2.5) for m in LINEITEM_METRICS}
LINEITEM_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber"]


def lineitem_history(lineitem: DataFrame) -> DataFrame:
    """lineitem -> readings of device = supplier, ordered by ship date."""
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("device_id"),
        *LINEITEM_ORDER, *LINEITEM_METRICS)


def load_lineitem_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_history(load_table(spark, sf_dir, "lineitem"))


# Damaged messages mixed into the wire form of the view: one kind per
# value of j = event_id % 150 (the anomaly spikes use 0, 50, 75, 100).
FAULTS = {
    10: "empty object",
    20: "broken JSON",
    30: "JSON array",
    40: "cpu NaN",
    60: "cpu not a number",
    70: "cpu above 100",
    80: "unknown event_type",
    90: "no timestamp",
    110: "model longer than 30",
    15: "throughput that the table's type cannot hold",
    55: "two objects",
    65: "a brace too many",
    120: "bytes that are not UTF-8",
    130: "signal above -40",
    140: "negative throughput",
}


# Values just outside a range that the table rounds into it (accepted).
EDGES = {25: ("cpu_usage_pct", 100.004), 35: ("signal_strength_dbm", -39.996), 45: ("throughput_mbps", -0.004)}


def partial_view(view: DataFrame) -> DataFrame:
    """Readings of which some lack a metric or a field that is not monitored."""
    e = F.col("event_id")
    return view.withColumns({
        "cpu_usage_pct": F.when(e % 7 != 3, F.col("cpu_usage_pct")),
        "signal_strength_dbm": F.when(e % 11 != 5, F.col("signal_strength_dbm")),
        "battery_pct": F.when(e % 5 != 2, F.col("battery_pct")),
        "model": F.when(e % 13 != 1, F.col("model"))})


def wire_messages(view: DataFrame, faults: bool = False, replay_below: int = 0) -> DataFrame:
    """The view as keyed JSON messages (offset = event_id). With ``faults``
    some messages are damaged (see FAULTS) and some on the edge of a range
    (EDGES); with ``replay_below`` = r the messages with j < r are delivered
    twice (at-least-once redelivery). Fields that are null are written as
    null in every other message and left out in the rest. The messages' own
    timestamps run backwards, as those of a lagging partition may."""
    from fleetscope.sources.messages import encode_events
    j = F.col("event_id") % 150
    src = view
    if faults:
        src = src.withColumns({
            "cpu_usage_pct": F.when(j == 40, F.lit(float("nan"))).when(j == 70, F.lit(120.0))
                              .otherwise(F.col("cpu_usage_pct").cast("double")),
            "event_type": F.when(j == 80, F.lit("other")).otherwise(F.col("event_type")),
            "model": F.when(j == 110, F.repeat(F.lit("M"), 31)).otherwise(F.col("model")),
            "signal_strength_dbm": F.when(j == 130, F.lit(-39.99))
                                    .otherwise(F.col("signal_strength_dbm").cast("double")),
            "throughput_mbps": F.when(j == 140, F.lit(-0.01)).when(j == 15, F.lit(999999.995))
                                .otherwise(F.col("throughput_mbps").cast("double"))})
        src = src.withColumns({f: F.when(j == n, F.lit(x)).otherwise(F.col(f)) for n, (f, x) in EDGES.items()})
    msgs = encode_events(src)
    explicit = encode_events(src, null_fields=True)
    msgs = msgs.where("offset % 2 = 0").unionByName(explicit.where("offset % 2 = 1"))
    msgs = msgs.withColumn("timestamp", F.timestamp_seconds(F.lit(1_800_000_000) - 600 * F.col("offset")))
    if faults:
        jm = F.col("offset") % 150
        text = F.col("value").cast("string")
        no_ts = F.regexp_replace(text, r'"timestamp":"[^"]*",', "")
        bad_cpu = F.regexp_replace(text, r'"cpu_usage_pct":[^,]*,', '"cpu_usage_pct":"x",')
        value = (F.when(jm == 10, F.lit("{}").cast("binary"))
                 .when(jm == 20, F.lit("{bad").cast("binary"))
                 .when(jm == 30, F.lit("[1]").cast("binary"))
                 .when(jm == 55, F.concat(F.col("value"), F.col("value")))
                 .when(jm == 60, bad_cpu.cast("binary"))
                 .when(jm == 65, F.concat(text, F.lit("}")).cast("binary"))
                 .when(jm == 90, no_ts.cast("binary"))
                 .when(jm == 120, F.concat(F.col("value"), F.unhex(F.lit("FF"))))
                 .otherwise(F.col("value")))
        msgs = msgs.withColumn("value", value)
    if replay_below:
        msgs = msgs.unionByName(msgs.where(F.col("offset") % 150 < replay_below))
    return msgs


#: Files of one chunk; with as many files per trigger, a trigger reads one chunk.
FILES = 4
#: Messages of one file, about, where a chunk has more than FILES of them.
FILE_ROWS = 1 << 16


def chunk_files(rows: int, chunks: int = 3) -> int:
    """Files of each of ``chunks`` chunks of ``rows`` messages: files, and with them the tasks that write and read them, grow
    in number with the messages, not in size."""
    return max(FILES, -(-rows // (chunks * FILE_ROWS)))


def write_wire_chunks(messages: DataFrame, path: str, chunks: int = 3, files: int = FILES) -> None:
    """Write messages as ``chunks`` sets of JSON files in offset order, one
    write per chunk, so a file stream (``files`` files per trigger) sees each
    device's readings in order across micro-batches. Every file holds an
    equal range of offsets and is written by a task of its own; a range
    without messages is an empty file, so that a trigger never reads parts of
    two chunks. Each chunk write makes only its own messages: the range of
    offsets goes down to the table they come from."""
    from fleetscope.functions.expressions import int_div
    bounds = messages.agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).first()
    if bounds["lo"] is None:
        return
    span = bounds["hi"] - bounds["lo"] + 1
    part = int_div((F.col("offset") - F.lit(bounds["lo"])) * (chunks * files), F.lit(span)).cast("int")
    for i in range(chunks):
        start, stop = (bounds["lo"] - (-k * span // chunks) for k in (i, i + 1))
        own = messages.where((F.col("offset") >= start) & (F.col("offset") < stop))
        chunk = own.withColumn("_file", part).repartitionById(files, F.col("_file") - i * files)
        (chunk.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                      "topic", "partition", "offset", "timestamp",
                      F.format_string("%d-%d", F.lit(bounds["lo"]), "_file").alias("_file"))
         .write.mode("append").option("compression", "gzip").partitionBy("_file").json(path))
        _fill_chunk(messages.sparkSession, path, [f"_file={bounds['lo']}-{n}" for n in range(i * files, (i + 1) * files)])


def _fill_chunk(spark: SparkSession, path: str, names: list[str]) -> None:
    """Empty files in those of the folders ``names`` that are missing, unless all are."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = {f.getPath().getName() for f in fs.listStatus(root)} if fs.exists(root) else set()
    if there.intersection(names):
        for n in names:
            if n not in there:
                fs.create(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{n}/empty.json")).close()
