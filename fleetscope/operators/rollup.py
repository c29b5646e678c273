"""Tumbling 5-minute rollup per (device, network) (operator 26).

Averages are ROUND(AVG(x), 2) of 2-decimal NUMERIC values, i.e. the exact
mean rounded half away from zero. They are computed from exact integer
sums of hundredths (``div_half_up``), so no double rounding and no
engine-dependent ties. One hash aggregation with a map-side partial step;
the group key includes the window, so a hot device is spread over as many
groups as it has windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.functions.expressions import div_half_up, to_cents
from fleetscope.schemas import ROLLUP_MINUTES

ROLLUP_KEYS = ["device_id", "network_type", "window_start"]
ROLLUP_COLUMNS = ROLLUP_KEYS + ["event_count", "avg_cpu", "max_cpu", "avg_memory", "avg_signal",
                                "avg_throughput", "min_throughput", "critical_count"]


def window_start(ts: str = "event_timestamp", minutes: int = ROLLUP_MINUTES) -> Column:
    """Start of the tumbling window (aligned to the hour, like
    date_trunc('minute') - minute % 5)."""
    return F.window(ts, f"{minutes} minutes").start


def _avg2(c: str) -> Column:
    return (div_half_up(F.sum(to_cents(c)), F.count(c)) / F.lit(100.0)).alias(c)


def rollup_aggs() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("event_count"),
        _avg2("cpu_usage_pct").alias("avg_cpu"),
        F.max(F.col("cpu_usage_pct").cast("double")).alias("max_cpu"),
        _avg2("memory_usage_pct").alias("avg_memory"),
        _avg2("signal_strength_dbm").alias("avg_signal"),
        _avg2("throughput_mbps").alias("avg_throughput"),
        F.min(F.col("throughput_mbps").cast("double")).alias("min_throughput"),
        F.count_if(F.col("event_type") == "critical").alias("critical_count"),
    ]


def rollup_5min(events: DataFrame, minutes: int = ROLLUP_MINUTES) -> DataFrame:
    return (events
            .groupBy("device_id", "network_type",
                     window_start("event_timestamp", minutes).alias("window_start"))
            .agg(*rollup_aggs()))


# Additive form: what a stored rollup keeps so new events can be merged in
# without re-reading old ones. ``finish_rollup`` turns it into the result.
_AVG_SOURCES = {"cpu": "cpu_usage_pct", "memory": "memory_usage_pct",
                "signal": "signal_strength_dbm", "throughput": "throughput_mbps"}


def partial_rollup(events: DataFrame, minutes: int = ROLLUP_MINUTES) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("event_count"),
            F.max(F.col("cpu_usage_pct").cast("double")).alias("max_cpu"),
            F.min(F.col("throughput_mbps").cast("double")).alias("min_throughput"),
            F.count_if(F.col("event_type") == "critical").alias("critical_count")]
    for short, col in _AVG_SOURCES.items():
        aggs += [F.sum(to_cents(col)).alias(f"sum_{short}_cents"), F.count(col).alias(f"n_{short}")]
    return (events.groupBy("device_id", "network_type",
                           window_start("event_timestamp", minutes).alias("window_start"))
            .agg(*aggs))


def merge_partial_rollups(parts: DataFrame) -> DataFrame:
    """Combine additive rollup rows of the same window (sums, max, min)."""
    aggs = [F.sum("event_count").alias("event_count"), F.max("max_cpu").alias("max_cpu"),
            F.min("min_throughput").alias("min_throughput"),
            F.sum("critical_count").alias("critical_count")]
    for short in _AVG_SOURCES:
        aggs += [F.sum(f"sum_{short}_cents").alias(f"sum_{short}_cents"),
                 F.sum(f"n_{short}").alias(f"n_{short}")]
    return parts.groupBy(*ROLLUP_KEYS).agg(*aggs)


def finish_rollup(parts: DataFrame) -> DataFrame:
    """Additive rollup rows -> the rollup columns (averages rounded half
    away from zero from exact integer sums)."""
    avg = {f"avg_{short}": (div_half_up(f"sum_{short}_cents", f"n_{short}") / F.lit(100.0))
           for short in _AVG_SOURCES}
    return parts.select(*ROLLUP_KEYS, F.col("event_count").cast("long").alias("event_count"),
                        avg["avg_cpu"].alias("avg_cpu"), "max_cpu",
                        avg["avg_memory"].alias("avg_memory"), avg["avg_signal"].alias("avg_signal"),
                        avg["avg_throughput"].alias("avg_throughput"), "min_throughput",
                        F.col("critical_count").cast("long").alias("critical_count"))
