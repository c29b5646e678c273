"""The 5-minute rollup as an incremental stream (operator 27).

Partial aggregates per micro-batch are merged in the state store, keyed by
(device, network, window); a window is emitted once, in append mode, when
the watermark (max event time seen - ``delay``) passes its end. Readings
later than the watermark are dropped by Spark; ``refresh_rollup``
recomputes touched months from the stored events when they must count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.operators.rollup import rollup_aggs
from fleetscope.schemas import ROLLUP_MINUTES


def rollup_5min_stream(readings: DataFrame, delay: str = "10 minutes",
                       minutes: int = ROLLUP_MINUTES) -> DataFrame:
    rows = readings.withWatermark("event_timestamp", delay)
    return (rows.groupBy("device_id", "network_type",
                     F.window("event_timestamp", f"{minutes} minutes").alias("w"))
            .agg(*rollup_aggs())
            .select("device_id", "network_type", F.col("w.start").alias("window_start"),
                    *[c for c in ("event_count", "avg_cpu", "max_cpu", "avg_memory", "avg_signal",
                                  "avg_throughput", "min_throughput", "critical_count")]))
