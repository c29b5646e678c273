"""Record layouts and the fixed values that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (must stay equal to the reference's for equal results) ---
# Monitored metrics, in the order alerts of one event are produced.
MONITORED_METRICS = ["cpu_usage_pct", "signal_strength_dbm", "throughput_mbps", "memory_usage_pct"]
# z-score thresholds per metric: (warning, critical); inclusive, critical tested first.
THRESHOLDS = {
    "cpu_usage_pct": (2.0, 3.0),
    "signal_strength_dbm": (1.8, 2.5),
    "throughput_mbps": (1.8, 2.5),
    "memory_usage_pct": (2.2, 3.2),
}
WINDOW_SIZE = 60          # readings kept per (device, metric)
MIN_STD = 1e-6            # flatter windows are not scored
SEVERITIES = ("warning", "critical")
EVENT_TYPES = ("normal", "degraded", "critical")
# Classification of a reading (strict comparisons).
CRITICAL_RULE = {"cpu_above": 85.0, "signal_below": -105.0, "throughput_below": 10.0}
DEGRADED_RULE = {"cpu_above": 70.0, "signal_below": -90.0, "throughput_below": 50.0}
# Inclusive value ranges of the stored event table (None = unbounded).
VALUE_RANGES = {
    "cpu_usage_pct": (0.0, 100.0),
    "memory_usage_pct": (0.0, 100.0),
    "signal_strength_dbm": (-120.0, -40.0),
    "throughput_mbps": (0.0, None),
    "battery_pct": (0.0, 100.0),
}
# Maximum text lengths of the stored event table.
TEXT_LENGTHS = {"device_id": 20, "model": 30, "firmware": 20, "network_type": 5, "event_type": 10}
# Stored decimal types of the numeric fields.
DECIMAL_TYPES = {
    "cpu_usage_pct": (5, 2),
    "memory_usage_pct": (5, 2),
    "signal_strength_dbm": (6, 2),
    "throughput_mbps": (8, 2),
    "battery_pct": (5, 2),
}
ROLLUP_MINUTES = 5
# --- end of fixed values ---

NUMERIC_FIELDS = ["cpu_usage_pct", "memory_usage_pct", "signal_strength_dbm",
                  "throughput_mbps", "battery_pct"]
TEXT_FIELDS = ["device_id", "model", "firmware", "network_type"]

# One reading as it travels on the wire (JSON object, `timestamp` is ISO-8601 text).
WIRE_EVENT_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType()) for f in TEXT_FIELDS]
    + [T.StructField("timestamp", T.StringType())]
    + [T.StructField(f, T.DoubleType()) for f in NUMERIC_FIELDS]
    + [T.StructField("event_type", T.StringType())]
)

# Column order of the stored event table (after conform_event).
EVENT_COLUMNS = TEXT_FIELDS + ["event_timestamp"] + NUMERIC_FIELDS + ["event_type"]

# Alert as stored (table names); the published message uses
# timestamp/mean/std_dev instead of detected_at/rolling_mean/rolling_std_dev.
ALERT_COLUMNS = ["device_id", "detected_at", "metric", "observed_value",
                 "rolling_mean", "rolling_std_dev", "z_score", "severity"]
