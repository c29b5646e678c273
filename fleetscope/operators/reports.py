"""Fleet reports over stored events and alerts (operators 22-25, 29-35).

All are plain DataFrame plans: filters and projections go first so the
Parquet scan reads only the needed columns and row groups; sort + limit
becomes ``TakeOrderedAndProject``; per-device top-k uses ``row_number``
with a ``<= k`` filter, which Spark turns into a partial group limit
before the shuffle (a hot device ships at most k rows per map task).
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.functions.expressions import render_time
from fleetscope.schemas import NUMERIC_FIELDS, SEVERITIES


def check_range(name: str, value: int, lo: int, hi: int) -> int:
    if not isinstance(value, int) or isinstance(value, bool) or not lo <= value <= hi:
        raise ValueError(f"{name} must be an integer in {lo}..{hi}, got {value!r}")
    return value


def check_severity(severity: str | None) -> str | None:
    if severity is not None and severity not in SEVERITIES:
        raise ValueError(f"severity must be one of {SEVERITIES}, got {severity!r}")
    return severity


def as_of_col(as_of) -> Column:
    """`as_of` literal (str/datetime/Column); None = the query's start time."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else F.lit(as_of)


def since(ts_col: str, as_of, minutes: int) -> Column:
    """ts >= as_of - minutes (inclusive, no upper bound)."""
    return F.col(ts_col) >= as_of_col(as_of) - F.make_dt_interval(mins=F.lit(minutes))


def since_pruned(df: DataFrame, ts_col: str, as_of, minutes: int) -> Column:
    """``since`` plus, on a month-partitioned stored table, the matching
    bound on ``event_month`` so Spark skips whole partitions (a filter on
    the timestamp alone does not prune the derived partition column)."""
    cond = since(ts_col, as_of, minutes)
    if "event_month" in df.columns:
        lower = as_of_col(as_of) - F.make_dt_interval(mins=F.lit(minutes))
        cond = cond & (F.col("event_month") >= F.date_format(lower, "yyyy-MM"))
    return cond


def _as_double(cols):
    return [F.col(c).cast("double").alias(c) for c in cols]


# -- operator 22 -----------------------------------------------------------
def device_summary(events: DataFrame, limit: int = 100) -> DataFrame:
    """One row per (device, model, firmware, network): event count and the
    newest timestamp (text); newest first. A device seen with two firmwares
    gives two rows."""
    check_range("limit", limit, 1, 1000)
    keys = ["device_id", "model", "firmware", "network_type"]
    g = (events.groupBy(*keys)
         .agg(F.count(F.lit(1)).alias("event_count"),
              F.max("event_timestamp").alias("_last")))
    top = g.orderBy(F.col("_last").desc(), *keys).limit(limit)
    return top.select(*keys, "event_count", render_time("_last").alias("last_seen"))


# -- operators 23-25 ------------------------------------------------------
def event_totals(events: DataFrame, as_of=None, approx: bool = False) -> DataFrame:
    distinct = (F.approx_count_distinct("device_id") if approx
                else F.count_distinct("device_id"))
    return events.agg(
        F.count(F.lit(1)).alias("total_events"),
        distinct.alias("unique_devices"),
        F.count_if(since("event_timestamp", as_of, 60)).alias("events_last_hour"))


def anomaly_totals(alerts: DataFrame, as_of=None) -> DataFrame:
    return alerts.agg(
        F.count(F.lit(1)).alias("total_anomalies"),
        F.count_if(F.col("severity") == "critical").alias("critical_anomalies"),
        F.count_if(since("detected_at", as_of, 60)).alias("anomalies_last_hour"))


def stats_summary(events: DataFrame, alerts: DataFrame, as_of=None) -> DataFrame:
    """Both totals as one row, missing values as 0. Two one-row aggregates
    are stacked and folded with max() -- no join needed."""
    ev = event_totals(events, as_of)
    an = anomaly_totals(alerts, as_of)
    names = ["total_events", "total_anomalies", "critical_anomalies", "unique_devices",
             "events_last_hour", "anomalies_last_hour"]
    def widen(df):
        return df.select(*[(F.col(n) if n in df.columns else F.lit(None).cast("long")).alias(n)
                           for n in names])
    stacked = widen(ev).unionByName(widen(an))
    return stacked.agg(*[F.coalesce(F.max(n), F.lit(0)).cast("long").alias(n) for n in names])


# -- operator 29 -----------------------------------------------------------
def percentile_name(p: float) -> str:
    """0.95 -> p95, 0.994 -> p99_4, 0.999 -> p99_9."""
    return "p" + format((Decimal(str(p)) * 100).normalize(), "f").replace(".", "_")


def ingest_lag_percentiles(df: DataFrame, group_cols: list[str], lag_col: str = "lag_ms",
                           percentiles=(0.95, 0.99), widths=(2.0 ** 16, 2.0 ** 6)) -> DataFrame:
    """Median (mean of the two middle values) and pXX = sorted[int(n*XX)]
    (0-based) of ``lag_col`` per group -- exact, without collecting a group.
    Rows without a lag do not count.

    The target ranks are followed down through buckets of falling
    ``widths``, in one plan: values are counted once (map-side combined),
    the counts summed up to each level of buckets, and on each level a
    window over the counts of the buckets that hold a target finds the next
    one. A window sees a group's counts in one bucket of the level above,
    never its rows, also without group columns.
    """
    names = {p: percentile_name(p) for p in percentiles}
    if len(set(names.values())) < len(names):
        raise ValueError("percentiles must differ")
    # never empty, and not a constant, so that it stays a grouping column
    g = list(group_cols) or ["_all"]
    lags = df.where(F.col(lag_col).isNotNull() & ~F.isnan(F.col(lag_col).cast("double")))
    lags = lags.withColumn("_all", F.pmod(F.hash(lag_col), F.lit(1))) if not group_cols else lags
    fine = lags.groupBy(*g, F.col(lag_col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    levels = [f"_b{i}" for i in range(len(widths) + 1)]
    buckets = [F.floor(F.col("_v") / F.lit(float(w))).cast("double") for w in widths] + [F.col("_v").cast("double")]
    counts = [fine.select(*g, *[b.alias(name) for b, name in zip(buckets, levels)], "_c")]
    for i in range(len(widths), 0, -1):
        counts.insert(0, counts[0].groupBy(*g, *levels[:i]).agg(F.sum("_c").alias("_c")))

    n = F.col("_n")
    ranks = {"lo": F.floor((n + 1) / 2), "hi": F.floor(n / 2) + 1}
    for p in percentiles:
        ranks[names[p]] = F.least(n, F.floor(n.cast("double") * F.lit(float(p))) + 1)
    wanted = F.array(*[F.struct(F.lit(k).alias("t"), r.cast("long").alias("rank")) for k, r in ranks.items()])

    open_ = None
    for i, level in enumerate(levels):
        above = [*g, *levels[:i]]
        rows = counts[i]
        if open_ is None:
            rows = rows.withColumn("_n", F.sum("_c").over(Window.partitionBy(*g))).withColumn("_targets", wanted)
        else:
            held = open_.select(*[F.col(c).alias(f"_held_{c}") for c in above], "_n", "_targets")
            same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_held_{c}")) for c in above])
            rows = rows.join(held, same).select(*above, level, "_c", "_n", "_targets")
        upto = Window.partitionBy(*above).orderBy(level).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumn("_before", F.sum("_c").over(upto) - F.col("_c"))
        here = F.filter("_targets", lambda t: (t["rank"] > F.col("_before")) & (t["rank"] <= F.col("_before") + F.col("_c")))
        left = F.transform(here, lambda t: F.struct(t["t"].alias("t"), (t["rank"] - F.col("_before")).alias("rank")))
        open_ = rows.select(*above, level, "_n", left.alias("_targets")).where(F.size("_targets") > 0)

    def val(t):
        return F.max(F.when(F.col("_t.t") == t, F.col(levels[-1])))

    aggs = [F.max("_n").alias("n"), ((val("lo") + val("hi")) / 2.0).alias("p50")]
    aggs += [val(name).alias(name) for name in names.values()]
    return (open_.select(*g, "_n", levels[-1], F.explode("_targets").alias("_t"))
            .groupBy(*g).agg(*aggs).select(*group_cols, "n", "p50", *names.values()))


# -- operator 30 -----------------------------------------------------------
def device_metrics(events: DataFrame, device_id: str, as_of=None, since_minutes: int = 60,
                   limit: int = 100) -> DataFrame:
    """One device's readings since as_of - N minutes, newest first. Use
    ``require_rows`` for the reference's "not found" signal."""
    check_range("since_minutes", since_minutes, 1, 1440)
    check_range("limit", limit, 1, 5000)
    rows = events.where((F.col("device_id") == device_id)
                        & since_pruned(events, "event_timestamp", as_of, since_minutes))
    top = rows.orderBy(F.col("event_timestamp").desc(),
                       *[F.col(c).desc() for c in _tiebreak(events)]).limit(limit)
    return top.select(render_time("event_timestamp").alias("event_timestamp"),
                      *_as_double(NUMERIC_FIELDS), "event_type")


def _tiebreak(df: DataFrame) -> list[str]:
    return ["event_id"] if "event_id" in df.columns else []


def device_metrics_fleet(events: DataFrame, as_of=None, since_minutes: int = 60,
                         limit: int = 100) -> DataFrame:
    """Fleet form of 30: the newest ``limit`` readings of every device."""
    check_range("since_minutes", since_minutes, 1, 1440)
    check_range("limit", limit, 1, 5000)
    rows = events.where(since_pruned(events, "event_timestamp", as_of, since_minutes))
    w = Window.partitionBy("device_id").orderBy(F.col("event_timestamp").desc(),
                                                *[F.col(c).desc() for c in _tiebreak(events)])
    ranked = rows.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= limit)
    return ranked.select("device_id", "rank",
                         render_time("event_timestamp").alias("event_timestamp"),
                         *_as_double(NUMERIC_FIELDS), "event_type")


class NotFound(LookupError):
    pass


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise NotFound if df is empty (reads at most one row)."""
    if not df.take(1):
        raise NotFound(f"{what}: no rows in the asked period")
    return df


# -- operators 31, 32, 35 ------------------------------------------------
def _alert_rows(df: DataFrame) -> DataFrame:
    return df.select("device_id", render_time("detected_at").alias("detected_at"), "metric",
                     *_as_double(["observed_value", "rolling_mean", "rolling_std_dev", "z_score"]),
                     "severity")


def _alert_order() -> list[Column]:
    return [F.col("detected_at").desc(), F.col("device_id"), F.col("metric")]


def device_anomalies(alerts: DataFrame, device_id: str, severity: str | None = None,
                     limit: int = 50) -> DataFrame:
    check_range("limit", limit, 1, 500)
    check_severity(severity)
    rows = alerts.where(F.col("device_id") == device_id)
    if severity:
        rows = rows.where(F.col("severity") == severity)
    return _alert_rows(rows.orderBy(*_alert_order()).limit(limit))


def device_anomalies_fleet(alerts: DataFrame, severity: str | None = None,
                           limit: int = 50) -> DataFrame:
    """Fleet form of 31: the newest ``limit`` alerts of every device."""
    check_range("limit", limit, 1, 500)
    check_severity(severity)
    rows = alerts.where(F.col("severity") == severity) if severity else alerts
    w = Window.partitionBy("device_id").orderBy(F.col("detected_at").desc(), F.col("metric"))
    ranked = rows.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= limit)
    return ranked.select(
        "rank", "device_id", render_time("detected_at").alias("detected_at"), "metric",
        *_as_double(["observed_value", "rolling_mean", "rolling_std_dev", "z_score"]), "severity")


def recent_anomalies(alerts: DataFrame, as_of=None, since_minutes: int = 60,
                     severity: str | None = None, limit: int = 100) -> DataFrame:
    check_range("limit", limit, 1, 1000)
    check_range("since_minutes", since_minutes, 1, 1440)
    check_severity(severity)
    rows = alerts.where(since_pruned(alerts, "detected_at", as_of, since_minutes))
    if severity:
        rows = rows.where(F.col("severity") == severity)
    return _alert_rows(rows.orderBy(*_alert_order()).limit(limit))


def anomalies_by_metric(alerts: DataFrame, metric: str, limit: int = 100) -> DataFrame:
    check_range("limit", limit, 1, 1000)
    rows = alerts.where(F.col("metric") == metric)
    return _alert_rows(rows.orderBy(*_alert_order()).limit(limit))


# -- operators 33, 34 -----------------------------------------------------
def _event_rows(df: DataFrame) -> DataFrame:
    return df.select("device_id", "network_type",
                     render_time("event_timestamp").alias("event_timestamp"),
                     *_as_double(NUMERIC_FIELDS), "event_type")


def critical_events(events: DataFrame, limit: int = 100) -> DataFrame:
    check_range("limit", limit, 1, 5000)
    rows = events.where(F.col("event_type") == "critical")
    return _event_rows(rows.orderBy(F.col("event_timestamp").desc(), "device_id",
                                    *_tiebreak(events)).limit(limit))


def network_segment_events(events: DataFrame, network_type: str, limit: int = 100) -> DataFrame:
    check_range("limit", limit, 1, 5000)
    rows = events.where(F.col("network_type") == network_type)
    return _event_rows(rows.orderBy(F.col("event_timestamp").desc(), "device_id",
                                    *_tiebreak(events)).limit(limit))
