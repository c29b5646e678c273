"""Per-batch progress counters (operator 10) and a running total without a
global window.

``Window.orderBy(x)`` with no partition puts every row in one task. The
running total here works in levels: rows are grouped into blocks of
``block`` consecutive order values, blocks into blocks of blocks, and so on
(``LEVELS`` levels, so the last table has a row per ``block ** LEVELS``
order values); each row adds what lies before it on every level. All
windows but that of the last table are partitioned by a block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.functions.expressions import int_div
from fleetscope.schemas import MONITORED_METRICS
from fleetscope.session import written


LEVELS = 2


def running_totals(df: DataFrame, order_col: str, sums: dict[str, str], block: int = 1024) -> DataFrame:
    """Add ``sums[src] = running sum of src`` ordered by the integer
    ``order_col`` (unique per row)."""
    upto = {s: f"_u_{s}" for s in sums}

    def before(table: DataFrame, key: str, level: int) -> DataFrame:
        """(key, _u_*): the sums of all rows of ``table`` with smaller keys."""
        w = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        if level == 0:
            return table.select(key, *[F.coalesce(F.sum(s).over(w), F.lit(0)).alias(upto[s]) for s in sums])
        up = f"{key}b"
        rows = table.withColumn(up, int_div(key, F.lit(block)))
        above = before(rows.groupBy(up).agg(*[F.sum(s).alias(s) for s in sums]), up, level - 1)
        w = Window.partitionBy(up).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        own = rows.select(key, up, *[F.coalesce(F.sum(s).over(w), F.lit(0)).alias(f"_own_{s}") for s in sums])
        return own.join(above, up).select(key, *[(F.col(upto[s]) + F.col(f"_own_{s}")).alias(upto[s]) for s in sums])

    rows = df.withColumn("_k", F.col(order_col))
    found = rows.join(before(rows.select("_k", *sums), "_k", LEVELS), "_k")
    for s, out in sums.items():
        found = found.withColumn(out, (F.col(upto[s]) + F.col(s)).cast("long"))
    return found.drop("_k", *upto.values())


def batch_progress(events: DataFrame, alerts: DataFrame, batch_col: str = "batch_id",
                   device_col: str = "device_id") -> DataFrame:
    """Per batch: events, anomalies, running totals of both and the number
    of devices tracked so far (devices whose first reading of a monitored
    metric is in a batch up to this one; without one there is no state)."""
    ev = events.groupBy(batch_col).agg(F.count(F.lit(1)).alias("events"))
    an = alerts.groupBy(batch_col).agg(F.count(F.lit(1)).alias("anomalies"))
    metrics = [F.col(m) for m in MONITORED_METRICS if m in events.columns]
    read = events.where(F.coalesce(*metrics).isNotNull()) if metrics else events
    first = (read.groupBy(device_col).agg(F.min(batch_col).alias(batch_col))
             .groupBy(batch_col).agg(F.count(F.lit(1)).alias("new_devices")))
    per = (ev.join(an, batch_col, "left").join(first, batch_col, "left")
           .fillna(0, ["anomalies", "new_devices"]))
    # a row for each batch; every level of the totals reads it
    out = running_totals(written(per, "progress"), batch_col, {"events": "total_processed",
                                          "anomalies": "total_anomalies",
                                          "new_devices": "devices_tracked"})
    return out.select(batch_col, "events", "anomalies", "total_processed", "total_anomalies",
                      "devices_tracked")
