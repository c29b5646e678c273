"""Event totals from mergeable daily rows (operators 22-25): counts, newest
time and a HyperLogLog sketch of the devices.

A day's row has a fixed size, whatever the number of devices, so totals over
any days read a few rows for each batch instead of the events. Counts are
exact; the number of devices is an estimate with a relative standard error
of about ``relative_error(lg_k)`` (1.6 % by default). Rows of one day from
several batches add up, also those of late events. Null devices are not
counted as a device; a null time has the null day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12  # 4,096 registers


def relative_error(lg_k: int = LG_K) -> float:
    return 1.04 / 2.0 ** (lg_k / 2.0)


def daily_sketches(events: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """One row for each day of the events; partial sketches are merged map-side."""
    if not 4 <= lg_k <= 21:
        raise ValueError("lg_k must be in 4..21")
    return events.groupBy(F.to_date("event_timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("event_type") == "critical").alias("critical_events"),
        F.max("event_timestamp").alias("last_seen"),
        F.hll_sketch_agg("device_id", F.lit(lg_k)).alias("devices"))


def totals_of_sketches(days: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals over daily rows: one row, or one for each value of ``by`` (such as the day). No rows: zeros and no time."""
    return days.groupBy(*(by or [])).agg(
        F.coalesce(F.sum("total_events"), F.lit(0)).alias("total_events"),
        F.coalesce(F.sum("critical_events"), F.lit(0)).alias("critical_events"),
        F.max("last_seen").alias("last_seen"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("devices")), F.lit(0).cast("long")).alias("unique_devices"))
