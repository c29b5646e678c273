"""Named queries over the test tables, each with its DuckDB oracle.

Every query reads the given tables (``events`` -> telemetry readings,
``lineitem`` -> long supplier histories) in full. Parameters that the
reference takes per request (device, as_of, limits) are fixed here so the
results are deterministic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.functions import expressions as X
from fleetscope.operators import detect as D
from fleetscope.operators import reports as R
from fleetscope.operators.rollup import rollup_5min
from fleetscope.plans import oracle as O
from fleetscope.schemas import ALERT_COLUMNS
from fleetscope.session import ensure_utc
from fleetscope.sources import fixtures as FX

AS_OF = "2024-01-31 00:00:00"
DEVICE = "DEV-00007"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


def telemetry(spark, sf_dir) -> DataFrame:
    return FX.load_telemetry(spark, sf_dir)


def alerts(spark, sf_dir) -> DataFrame:
    return D.detect_anomalies(telemetry(spark, sf_dir))


_STORED: dict[tuple, str] = {}


def _stored(spark, sf_dir, name: str, write) -> str:
    """A table written once per application and data folder, as the ingest
    path would have left it; the lookups read it."""
    from fleetscope.session import new_subdir
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = f"{new_subdir(spark, 'stored')}/{name}"
        write(path)
        _STORED[key] = path
    return _STORED[key]


def stored_alerts(spark, sf_dir) -> DataFrame:
    """The alert table: month partitions, NUMERIC columns read as doubles."""
    from fleetscope.streaming.sinks import read_alerts, write_anomaly_alerts
    return read_alerts(spark, _stored(spark, sf_dir, "alerts", lambda path: write_anomaly_alerts(
        alerts(spark, sf_dir), 0, path)))


def stored_events(spark, sf_dir) -> DataFrame:
    """The event table: month partitions, sorted by device and time."""
    from fleetscope.streaming.sinks import write_events_by_month
    return spark.read.parquet(_stored(spark, sf_dir, "events", lambda path: write_events_by_month(
        telemetry(spark, sf_dir), 0, path, extra=["event_id"])))


# ---------------------------------------------------------------- detection
@register("detect_anomalies", O.telemetry_alerts_sql())
def q_detect(spark, sf_dir):
    """Flagship: sliding-window z-score alerts over all readings."""
    return alerts(spark, sf_dir)


@register("detect_anomalies_lineitem", O.lineitem_alerts_sql())
def q_detect_lineitem(spark, sf_dir):
    """Long histories (500+ readings per supplier): eviction fully used."""
    return D.detect_anomalies(
        FX.load_lineitem_history(spark, sf_dir), time_col="l_shipdate",
        order_cols=FX.LINEITEM_ORDER, metrics=FX.LINEITEM_METRICS,
        thresholds=FX.LINEITEM_THRESHOLDS)


@register("detect_anomalies_blocked", O.lineitem_alerts_sql())
def q_detect_blocked(spark, sf_dir):
    """The same with blocks of 150 readings: every supplier is split into
    several blocks and stitched by the edge pass."""
    return D.detect_anomalies(
        FX.load_lineitem_history(spark, sf_dir), time_col="l_shipdate",
        order_cols=FX.LINEITEM_ORDER, metrics=FX.LINEITEM_METRICS,
        thresholds=FX.LINEITEM_THRESHOLDS, target_rows=150)


_NULL_ORDER = ["sent", "l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"]


@register("detect_anomalies_null_order", O.alerts_sql(
    "(SELECT *, CASE WHEN l_orderkey % 5 <> 0 THEN l_shipdate END AS sent FROM lineitem) v", "cast(l_suppkey AS varchar)",
    "l_shipdate", ["sent NULLS FIRST", *_NULL_ORDER[1:]], O.LINEITEM_METRICS, {m: (1.8, 2.5) for m in O.LINEITEM_METRICS}))
def q_detect_null_order(spark, sf_dir):
    """A fifth of the rows lack their first order value: they come first and
    are split into blocks like all others."""
    rows = FX.load_lineitem_history(spark, sf_dir).withColumn("sent", F.expr("CASE WHEN l_orderkey % 5 <> 0 THEN l_shipdate END"))
    return D.detect_anomalies(rows, time_col="l_shipdate", order_cols=_NULL_ORDER, metrics=FX.LINEITEM_METRICS,
                              thresholds=FX.LINEITEM_THRESHOLDS, target_rows=50)


_LIMITS_SQL = f"""(SELECT * REPLACE (
  cast(CASE WHEN event_id % 41 = 0 THEN 0 ELSE 999999.99 - (event_id % 89) * (event_id % 7) / 100.0 END AS decimal(8,2)) AS throughput_mbps)
  FROM ({O.TELEMETRY_SQL}) tv) lv"""


@register("detect_anomalies_limits", O.alerts_sql(
    _LIMITS_SQL, "device_id", "event_timestamp", ["event_timestamp", "event_id"], O.METRICS, O.THRESHOLDS))
def q_detect_limits(spark, sf_dir):
    """Throughput at the limits of its stored type: sums beyond BIGINT."""
    top = F.expr("cast(CASE WHEN event_id % 41 = 0 THEN 0 ELSE 999999.99 - (event_id % 89) * (event_id % 7) / 100.0 END "
                 "AS decimal(8,2))")
    return D.detect_anomalies(telemetry(spark, sf_dir).withColumn("throughput_mbps", top))


_LONG_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


@register("rolling_stats_large", f"""
SELECT l_returnflag, {', '.join(_LONG_ORDER)}, n, CAST(s AS bigint) AS s,
       round(sqrt(cast(n::hugeint * q - s::hugeint * s AS double)) / (n * 100), 6) AS std
FROM (SELECT *, count(*) OVER w AS n, sum(c) OVER w AS s, sum(c::hugeint * c) OVER w AS q
      FROM (SELECT *, cast(round(l_extendedprice * 100) AS bigint) AS c FROM lineitem) v
      WINDOW w AS (PARTITION BY l_returnflag ORDER BY {', '.join(_LONG_ORDER)}
                   ROWS BETWEEN 9999 PRECEDING AND CURRENT ROW)) x""")
def q_rolling_stats_large(spark, sf_dir):
    """Statistics over the last 10,000 rows by running sums, stitched over
    blocks of about 25,000 rows."""
    rows = FX.load_table(spark, sf_dir, "lineitem").select(
        "l_returnflag", *_LONG_ORDER, F.col("l_extendedprice").cast("double").alias("x"))
    st = D.rolling_stats(rows, ["l_returnflag"], _LONG_ORDER, window=10_000, target_rows=25_000)
    cols = D.stats_columns(10_000)
    return st.select("l_returnflag", *_LONG_ORDER, "n", "s", F.round(cols["std"], 6).alias("std"))


_LONG_SQL = " UNION ALL ".join(
    f"SELECT device_id, event_id, '{m}' AS metric, cast({m} AS double) AS x FROM telemetry"
    for m in O.METRICS)


@register("unpivot_metrics", O.with_views(_LONG_SQL))
def q_unpivot(spark, sf_dir):
    return D.unpivot_metrics(telemetry(spark, sf_dir), ["device_id", "event_id"])


def _stats(spark, sf_dir):
    long = D.unpivot_metrics(telemetry(spark, sf_dir), ["device_id", "event_timestamp", "event_id"])
    return D.rolling_stats(long, ["device_id", "metric"], ["event_timestamp", "event_id"])


_STATS_SQL = O.with_views(f"""
SELECT device_id, event_id, metric, n, s, q, cast(s AS double) / (n * 100) AS mean,
       sqrt(cast(n::hugeint * q - s::hugeint * s AS double)) / (n * 100) AS std
FROM ({O.window_stats_sql('telemetry', 'device_id', ['event_timestamp', 'event_id'],
                          O.METRICS, ['event_timestamp', 'event_id'])}) w""")


@register("rolling_stats", _STATS_SQL)
def q_rolling_stats(spark, sf_dir):
    """n, exact sums and mean/std over the last 60 readings of every row."""
    st = _stats(spark, sf_dir)
    cols = D.stats_columns()
    return st.select("device_id", "event_id", "metric", "n", "s", "q",
                     cols["mean"].alias("mean"), cols["std"].alias("std"))


_Z_SQL = O.with_views(f"""
SELECT device_id, event_id, metric, z,
       CASE WHEN z >= {O.thresholds_case(O.THRESHOLDS, 1)} THEN 'critical'
            WHEN z >= {O.thresholds_case(O.THRESHOLDS, 0)} THEN 'warning' END AS severity
FROM ({O.scored_sql(O.window_stats_sql('telemetry', 'device_id', ['event_timestamp', 'event_id'],
                                       O.METRICS, ['event_timestamp', 'event_id']))}) t""")


_ZONLY_SQL = O.with_views(f"""
SELECT device_id, event_id, metric, z
FROM ({O.scored_sql(O.window_stats_sql('telemetry', 'device_id', ['event_timestamp', 'event_id'],
                                       O.METRICS, ['event_timestamp', 'event_id']))}) t""")


@register("zscore_guarded", _ZONLY_SQL)
def q_zscore(spark, sf_dir):
    """z per (reading, metric); NULL while warming up or on a flat window."""
    return D.zscore_guarded(_stats(spark, sf_dir)).select("device_id", "event_id", "metric", "z")


@register("severity_for", _Z_SQL)
def q_severity(spark, sf_dir):
    """z with its severity (NULL below the warning threshold)."""
    z = D.zscore_guarded(_stats(spark, sf_dir))
    return D.severity_for(z).select("device_id", "event_id", "metric", "z", "severity")


# thresholds that users keep in a table: some metrics' own, and some devices'
_THRESHOLDS_SQL = """
SELECT 'cpu_usage_pct' AS metric, NULL AS device_id, 2.1 AS warning, 2.9 AS critical
UNION ALL SELECT 'throughput_mbps', NULL, 1.9, NULL UNION ALL SELECT 'signal_strength_dbm', NULL, NULL, 2.4
UNION ALL SELECT 'no_such_metric', NULL, 0.0, 0.0 UNION ALL SELECT NULL, NULL, 0.0, 0.0
UNION ALL SELECT 'cpu_usage_pct', NULL, 2.2, 2.8
UNION ALL SELECT DISTINCT m, concat('DEV-', lpad(cast(user_id AS {text}), 5, '0')), 1.5 + user_id % 4 / 4.0,
       CASE WHEN user_id % 3 <> 0 THEN 2.0 + user_id % 5 / 5.0 END
FROM events, (SELECT 'cpu_usage_pct' AS m UNION ALL SELECT 'memory_usage_pct') k WHERE user_id % 6 = 1"""


@register("severity_table", O.with_views(f"""
, thresholds AS (SELECT metric, device_id, min(warning)::double AS warning, min(critical)::double AS critical
  FROM ({_THRESHOLDS_SQL.format(text='varchar')}) u GROUP BY ALL)
SELECT z.device_id, event_id, z.metric, z,
  CASE WHEN z >= CASE WHEN d.metric IS NULL THEN m.critical ELSE d.critical END THEN 'critical'
       WHEN z >= CASE WHEN d.metric IS NULL THEN m.warning ELSE d.warning END THEN 'warning' END AS severity
FROM ({_ZONLY_SQL}) z
LEFT JOIN thresholds m ON m.metric = z.metric AND m.device_id IS NULL
LEFT JOIN thresholds d ON d.metric = z.metric AND d.device_id = z.device_id"""))
def q_severity_table(spark, sf_dir):
    """Severity by a relation of thresholds: the metric's own or a device's,
    missing limits, metrics without any."""
    FX.load_table(spark, sf_dir, "events").createOrReplaceTempView("fleetscope_events")
    th = spark.sql(_THRESHOLDS_SQL.format(text="string").replace("FROM events", "FROM fleetscope_events"))
    z = D.zscore_guarded(_stats(spark, sf_dir))
    return D.severity_for(z, th).select("device_id", "event_id", "metric", "z", "severity")


@register("tracked_devices", O.with_views(
    "SELECT count(DISTINCT device_id) AS devices_tracked FROM telemetry WHERE "
    + " OR ".join(f"{m} IS NOT NULL" for m in O.METRICS)))
def q_tracked(spark, sf_dir):
    return D.tracked_devices(telemetry(spark, sf_dir))


# ---------------------------------------------------------------- row-wise
@register("classify_event_type", O.with_views(
    "SELECT event_id, CASE WHEN cpu_usage_pct > 85 OR signal_strength_dbm < -105 OR throughput_mbps < 10 "
    "THEN 'critical' WHEN cpu_usage_pct > 70 OR signal_strength_dbm < -90 OR throughput_mbps < 50 "
    "THEN 'degraded' ELSE 'normal' END AS event_type FROM telemetry"))
def q_classify(spark, sf_dir):
    t = telemetry(spark, sf_dir).drop("event_type")
    return X.classify_event_type(t).select("event_id", "event_type")


def raw_readings(spark, sf_dir) -> DataFrame:
    """Unclamped readings derived from events.value (some out of range, some missing or not a number)."""
    ev = FX.load_table(spark, sf_dir, "events")
    missing = lambda k, c: F.when(F.col("event_id") % 7 != k, c)
    return ev.select(
        "event_id",
        missing(0, F.when(F.col("event_id") % 11 == 5, F.lit(float("nan"))).otherwise(F.col("value") / 5.0 - 10)).alias("cpu_usage_pct"),
        missing(1, F.col("value") / 5.0).alias("memory_usage_pct"),
        missing(2, -F.col("value") * 0.18 - 30).alias("signal_strength_dbm"),
        missing(3, F.col("value") - 100).alias("throughput_mbps"),
        (F.col("value") * 0.18).alias("battery_pct"))


_RAW_SQL = """raw AS (SELECT event_id,
  CASE WHEN event_id % 7 <> 0 THEN CASE WHEN event_id % 11 = 5 THEN 'nan'::double ELSE value / 5.0 - 10 END END AS cpu_usage_pct,
  CASE WHEN event_id % 7 <> 1 THEN value / 5.0 END AS memory_usage_pct,
  CASE WHEN event_id % 7 <> 2 THEN -value * 0.18 - 30 END AS signal_strength_dbm,
  CASE WHEN event_id % 7 <> 3 THEN value - 100 END AS throughput_mbps, value * 0.18 AS battery_pct
  FROM (SELECT event_id, cast(value AS double) AS value FROM events) e)"""


def _round2_sql(x: str) -> str:
    # the decimal digits of the double, rounded half away from zero
    return f"cast(round(cast(cast({x} AS varchar) AS decimal(38,18)), 2) AS double)"


def _clamped_sql(column: str, clamped: str) -> str:
    # least and greatest skip nulls
    return f"CASE WHEN {column} IS NULL OR isnan({column}) THEN {column} ELSE {_round2_sql(clamped)} END AS {column}"


@register("clamp_metrics", f"""WITH {_RAW_SQL}
SELECT event_id,
  {_clamped_sql('cpu_usage_pct', 'least(greatest(cpu_usage_pct, 0.0), 100.0)')},
  {_clamped_sql('memory_usage_pct', 'least(greatest(memory_usage_pct, 0.0), 100.0)')},
  {_clamped_sql('signal_strength_dbm', 'least(greatest(signal_strength_dbm, -120.0), -40.0)')},
  {_clamped_sql('throughput_mbps', 'greatest(throughput_mbps, 0.0)')},
  {_clamped_sql('battery_pct', 'battery_pct')}
FROM raw""")
def q_clamp(spark, sf_dir):
    return X.clamp_metrics(raw_readings(spark, sf_dir))


def _wire_time_text(ts: str = "event_timestamp"):
    """ISO-8601 texts in three spellings: +00:00 with micros, Z, whole seconds."""
    iso = X.iso_text(F.col(ts))
    k = F.col("event_id") % 3
    return (F.when(k == 0, iso)
            .when(k == 1, F.concat(F.substring(iso, 1, 26), F.lit("Z")))
            .otherwise(F.concat(F.substring(iso, 1, 19), F.lit("+00:00"))))


@register("parse_event_time", O.with_views("""
SELECT event_id, CASE WHEN event_id % 3 = 2 THEN date_trunc('second', event_timestamp)
                      ELSE event_timestamp END AS event_timestamp FROM telemetry"""))
def q_parse_time(spark, sf_dir):
    t = telemetry(spark, sf_dir).select("event_id", _wire_time_text().alias("ts_text"))
    return t.select("event_id",
                    X.parse_event_time("ts_text").cast("timestamp_ntz").alias("event_timestamp"))


@register("render_time", O.with_views(
    "SELECT event_id, cast(event_timestamp AS varchar) AS event_time FROM telemetry"))
def q_render_time(spark, sf_dir):
    return telemetry(spark, sf_dir).select("event_id", X.render_time("event_timestamp").alias("event_time"))


# ---------------------------------------------------------------- aggregates
@register("device_summary", O.with_views("""
SELECT device_id, model, firmware, network_type, count(*) AS event_count,
       cast(max(event_timestamp) AS varchar) AS last_seen
FROM telemetry GROUP BY device_id, model, firmware, network_type
ORDER BY max(event_timestamp) DESC, device_id, model, firmware, network_type LIMIT 100"""))
def q_device_summary(spark, sf_dir):
    return R.device_summary(telemetry(spark, sf_dir), limit=100)


_EVENT_TOTALS = f"""SELECT count(*) AS total_events, count(DISTINCT device_id) AS unique_devices,
  count(*) FILTER (WHERE event_timestamp >= {O.AS_OF} - INTERVAL 60 MINUTE) AS events_last_hour
FROM telemetry"""
_ANOMALY_TOTALS = f"""SELECT count(*) AS total_anomalies,
  count(*) FILTER (WHERE severity = 'critical') AS critical_anomalies,
  count(*) FILTER (WHERE detected_at >= {O.AS_OF} - INTERVAL 60 MINUTE) AS anomalies_last_hour
FROM alerts"""


@register("event_totals", O.with_views(_EVENT_TOTALS))
def q_event_totals(spark, sf_dir):
    return R.event_totals(telemetry(spark, sf_dir), as_of=AS_OF)


@register("event_totals_approx", O.with_views("""
SELECT cast(cast(event_timestamp AS date) AS varchar) AS day, count(*) AS total_events,
  count(*) FILTER (WHERE event_type = 'critical') AS critical_events,
  cast(max(event_timestamp) AS varchar) AS last_seen, TRUE AS devices_within_error
FROM telemetry GROUP BY GROUPING SETS ((1), ())"""))
def q_event_totals_approx(spark, sf_dir):
    """Totals by day and over all days (no day) from stored daily sketches
    of three batches, the last with late events and written twice; devices
    within four standard errors of the exact number."""
    from fleetscope.operators.sketches import relative_error, totals_of_sketches
    from fleetscope.session import new_subdir
    from fleetscope.streaming.sinks import write_daily_sketches
    path, t = f"{new_subdir(spark, 'sketches')}/days", telemetry(spark, sf_dir)
    for k in (0, 1, 2, 2):
        write_daily_sketches(t.where(F.col("event_id") % 3 == k), k, path)
    days = spark.read.parquet(path)
    none = F.lit(None).cast("date").alias("day")
    got = totals_of_sketches(days, ["day"]).unionByName(totals_of_sketches(days).withColumn("day", none))
    daily = t.withColumn("day", F.to_date("event_timestamp"))
    exact = F.count_distinct("device_id").alias("exact")
    exact = daily.groupBy("day").agg(exact).unionByName(daily.agg(exact).withColumn("day", none))
    off = F.abs(F.col("unique_devices") - F.col("exact")) / F.col("exact")
    return got.join(exact.withColumnRenamed("day", "_day"), F.col("day").eqNullSafe(F.col("_day"))).select(
        F.col("day").cast("string").alias("day"), "total_events", "critical_events", X.render_time("last_seen").alias("last_seen"),
        (off <= 4 * relative_error()).alias("devices_within_error"))


@register("anomaly_totals", O.with_views(_ANOMALY_TOTALS, alerts=True))
def q_anomaly_totals(spark, sf_dir):
    return R.anomaly_totals(stored_alerts(spark, sf_dir), as_of=AS_OF)


_SUMMARY_SQL = O.with_views(f"""
SELECT e.total_events, a.total_anomalies, a.critical_anomalies, e.unique_devices,
       e.events_last_hour, a.anomalies_last_hour
FROM ({_EVENT_TOTALS}) e, ({_ANOMALY_TOTALS}) a""", alerts=True)


@register("pipeline_stats", _SUMMARY_SQL)
@register("stats_summary", _SUMMARY_SQL)
def q_stats_summary(spark, sf_dir):
    """Operator 25 over the stored events and alerts; the reference's
    /stats/summary."""
    return R.stats_summary(stored_events(spark, sf_dir), stored_alerts(spark, sf_dir), as_of=AS_OF)


def _cents_avg_sql(c: str) -> str:
    s = f"cast(sum(cast(round({c} * 100) AS bigint)) AS bigint)"
    return f"cast({O.half_up_sql(s, f'count({c})')} AS double) / 100"


_ROLLUP_SQL = O.with_views(f"""
SELECT device_id, network_type, window_start, count(*) AS event_count,
  {_cents_avg_sql('cpu_usage_pct')} AS avg_cpu, cast(max(cpu_usage_pct) AS double) AS max_cpu,
  {_cents_avg_sql('memory_usage_pct')} AS avg_memory, {_cents_avg_sql('signal_strength_dbm')} AS avg_signal,
  {_cents_avg_sql('throughput_mbps')} AS avg_throughput,
  cast(min(throughput_mbps) AS double) AS min_throughput,
  count(*) FILTER (WHERE event_type = 'critical') AS critical_count
FROM (SELECT *, date_trunc('minute', event_timestamp)
              - to_minutes(cast(extract(minute FROM event_timestamp) AS bigint) % 5) AS window_start
      FROM telemetry) t
GROUP BY device_id, network_type, window_start""")


@register("rollup_5min", _ROLLUP_SQL)
def q_rollup(spark, sf_dir):
    return rollup_5min(telemetry(spark, sf_dir))


# Arrival lag in ms: the delivery delay (events.value, seconds) to the
# microsecond; some readings have not arrived (NULL).
_LAG_SQL = """SELECT concat('DEV-', lpad(cast(user_id AS varchar), 5, '0')) AS device_id,
  CASE WHEN event_id % 9 <> 4 THEN cast(round(value * 1000000) AS bigint) / 1000.0 END AS lag_ms FROM events"""


def _lag_sql(group: str) -> str:
    picks = ", ".join(
        f"cast(max(CASE WHEN r = least(n, floor({p}::double * n) + 1) THEN lag_ms END) AS double) AS {name}"
        for p, name in ((0.95, "p95"), (0.99, "p99"), (0.994, "p99_4"), (0.999, "p99_9")))
    return f"""
SELECT {group} cast(max(n) AS bigint) AS n,
  (max(CASE WHEN r = (n + 1) // 2 THEN lag_ms END) + max(CASE WHEN r = n // 2 + 1 THEN lag_ms END)) / 2.0 AS p50, {picks}
FROM (SELECT *, row_number() OVER (PARTITION BY {group or 'NULL,'} 1 ORDER BY lag_ms) AS r,
             count(*) OVER (PARTITION BY {group or 'NULL,'} 1) AS n
      FROM ({_LAG_SQL}) l WHERE lag_ms IS NOT NULL) x
{'GROUP BY device_id' if group else ''}"""


def _lags(spark, sf_dir) -> DataFrame:
    """Lag of every reading; arrival is stamped as event time + delay."""
    from fleetscope.operators.ingest import ingest_lag_ms, stamp_ingest_time
    ev = FX.load_table(spark, sf_dir, "events")
    delay_us = F.round(F.col("value") * 1_000_000).cast("long")
    view = FX.telemetry_view(ev.withColumn("_delay_us", delay_us), carry=["_delay_us"])
    arrival = F.col("event_timestamp") + F.make_dt_interval(
        secs=(F.col("_delay_us") / 1_000_000).cast("decimal(18,6)"))
    arrived = F.when(F.col("event_id") % 9 != 4, arrival)
    return stamp_ingest_time(view, at=arrived).select(
        "device_id", ingest_lag_ms("ingested_at", "event_timestamp").alias("lag_ms"))


_PERCENTILES = (0.95, 0.99, 0.994, 0.999)


@register("ingest_lag_percentiles", _lag_sql("device_id,"))
def q_ingest_lag(spark, sf_dir):
    """Median and percentiles of arrival lag per device."""
    return R.ingest_lag_percentiles(_lags(spark, sf_dir), ["device_id"], percentiles=_PERCENTILES)


@register("ingest_lag_percentiles_total", _lag_sql(""))
def q_ingest_lag_total(spark, sf_dir):
    """The same over all devices together."""
    return R.ingest_lag_percentiles(_lags(spark, sf_dir), [], percentiles=_PERCENTILES)


# ---------------------------------------------------------------- lookups
_EV_COLS_SQL = ("cast(cpu_usage_pct AS double) AS cpu_usage_pct, cast(memory_usage_pct AS double) AS memory_usage_pct, "
                "cast(signal_strength_dbm AS double) AS signal_strength_dbm, "
                "cast(throughput_mbps AS double) AS throughput_mbps, cast(battery_pct AS double) AS battery_pct, event_type")
_AL_COLS_SQL = ("device_id, cast(detected_at AS varchar) AS detected_at, metric, observed_value, rolling_mean, "
                "rolling_std_dev, z_score, severity")


@register("device_metrics", O.with_views(f"""
SELECT cast(event_timestamp AS varchar) AS event_timestamp, {_EV_COLS_SQL} FROM telemetry
WHERE device_id = '{DEVICE}' AND event_timestamp >= {O.AS_OF} - INTERVAL 1440 MINUTE
ORDER BY telemetry.event_timestamp DESC, event_id DESC LIMIT 100"""))
def q_device_metrics(spark, sf_dir):
    return R.device_metrics(stored_events(spark, sf_dir), DEVICE, as_of=AS_OF, since_minutes=1440, limit=100)


@register("device_metrics_fleet", O.with_views(f"""
SELECT device_id, rank, cast(event_timestamp AS varchar) AS event_timestamp, {_EV_COLS_SQL} FROM (
  SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY event_timestamp DESC, event_id DESC) AS rank
  FROM telemetry WHERE event_timestamp >= {O.AS_OF} - INTERVAL 1440 MINUTE) t WHERE rank <= 3"""))
def q_device_metrics_fleet(spark, sf_dir):
    return R.device_metrics_fleet(stored_events(spark, sf_dir), as_of=AS_OF, since_minutes=1440, limit=3)


@register("device_anomalies", O.with_views(f"""
SELECT {_AL_COLS_SQL} FROM alerts WHERE device_id = '{DEVICE}'
ORDER BY alerts.detected_at DESC, device_id, metric LIMIT 50""", alerts=True))
def q_device_anomalies(spark, sf_dir):
    return R.device_anomalies(stored_alerts(spark, sf_dir), DEVICE, limit=50)


@register("device_anomalies_fleet", O.with_views(f"""
SELECT rank, {_AL_COLS_SQL} FROM (
  SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY detected_at DESC, metric) AS rank
  FROM alerts WHERE severity = 'critical') t WHERE rank <= 2""", alerts=True))
def q_device_anomalies_fleet(spark, sf_dir):
    return R.device_anomalies_fleet(stored_alerts(spark, sf_dir), severity="critical", limit=2)


@register("recent_anomalies", O.with_views(f"""
SELECT {_AL_COLS_SQL} FROM alerts WHERE detected_at >= {O.AS_OF} - INTERVAL 1440 MINUTE
ORDER BY alerts.detected_at DESC, device_id, metric LIMIT 100""", alerts=True))
def q_recent_anomalies(spark, sf_dir):
    return R.recent_anomalies(stored_alerts(spark, sf_dir), as_of=AS_OF, since_minutes=1440, limit=100)


@register("device_anomalies_critical", O.with_views(f"""
SELECT {_AL_COLS_SQL} FROM alerts WHERE device_id = '{DEVICE}' AND severity = 'critical'
ORDER BY alerts.detected_at DESC, device_id, metric LIMIT 50""", alerts=True))
def q_device_anomalies_critical(spark, sf_dir):
    return R.device_anomalies(stored_alerts(spark, sf_dir), DEVICE, severity="critical", limit=50)


@register("recent_anomalies_critical", O.with_views(f"""
SELECT {_AL_COLS_SQL} FROM alerts WHERE detected_at >= {O.AS_OF} - INTERVAL 1440 MINUTE AND severity = 'critical'
ORDER BY alerts.detected_at DESC, device_id, metric LIMIT 100""", alerts=True))
def q_recent_anomalies_critical(spark, sf_dir):
    return R.recent_anomalies(stored_alerts(spark, sf_dir), as_of=AS_OF, since_minutes=1440, severity="critical", limit=100)


@register("anomalies_by_metric", O.with_views(f"""
SELECT {_AL_COLS_SQL} FROM alerts WHERE metric = 'signal_strength_dbm'
ORDER BY alerts.detected_at DESC, device_id, metric LIMIT 100""", alerts=True))
def q_anomalies_by_metric(spark, sf_dir):
    return R.anomalies_by_metric(stored_alerts(spark, sf_dir), "signal_strength_dbm", limit=100)


_EVENT_ROW_SQL = f"device_id, network_type, cast(event_timestamp AS varchar) AS event_timestamp, {_EV_COLS_SQL}"


@register("critical_events", O.with_views(f"""
SELECT {_EVENT_ROW_SQL} FROM telemetry WHERE event_type = 'critical'
ORDER BY telemetry.event_timestamp DESC, device_id, event_id LIMIT 100"""))
def q_critical_events(spark, sf_dir):
    return R.critical_events(stored_events(spark, sf_dir), limit=100)


@register("network_segment_events", O.with_views(f"""
SELECT {_EVENT_ROW_SQL} FROM telemetry WHERE network_type = 'wifi'
ORDER BY telemetry.event_timestamp DESC, device_id, event_id LIMIT 100"""))
def q_network_segment_events(spark, sf_dir):
    return R.network_segment_events(stored_events(spark, sf_dir), "wifi", limit=100)


# ---------------------------------------------------------------- messages
_FAULT_REASONS = {
    10: ",".join(f"missing:{f}" for f in ["device_id", "model", "firmware", "network_type", "timestamp",
                                          "cpu_usage_pct", "memory_usage_pct", "signal_strength_dbm",
                                          "throughput_mbps", "battery_pct", "event_type"]),
    15: "out_of_range:throughput_mbps", 55: "malformed", 65: "malformed",
    20: "malformed", 30: "malformed", 60: "malformed", 120: "malformed",
    40: "not_finite:cpu_usage_pct", 70: "out_of_range:cpu_usage_pct",
    80: "bad_value:event_type", 90: "missing:timestamp", 110: "too_long:model",
    130: "out_of_range:signal_strength_dbm", 140: "out_of_range:throughput_mbps",
}
_FAULT_CASE = "CASE event_id % 150 " + " ".join(
    f"WHEN {j} THEN '{r}'" for j, r in _FAULT_REASONS.items()) + " ELSE '' END"
_FAULT_LIST = ", ".join(str(j) for j in _FAULT_REASONS)
_TABLE_COLS_SQL = ("device_id, model, firmware, network_type, event_timestamp, "
                   "cast(cpu_usage_pct AS double) AS cpu_usage_pct, cast(memory_usage_pct AS double) AS memory_usage_pct, "
                   "cast(signal_strength_dbm AS double) AS signal_strength_dbm, "
                   "cast(throughput_mbps AS double) AS throughput_mbps, cast(battery_pct AS double) AS battery_pct, "
                   "event_type")


# the accepted edge values (FX.EDGES) as the table rounds them
_EDGE_COLS_SQL = _TABLE_COLS_SQL
for _j, _f, _v in ((25, "cpu_usage_pct", 100.0), (35, "signal_strength_dbm", -40.0), (45, "throughput_mbps", 0.0)):
    _EDGE_COLS_SQL = _EDGE_COLS_SQL.replace(
        f"cast({_f} AS double) AS {_f}", f"CASE WHEN event_id % 150 = {_j} THEN {_v} ELSE cast({_f} AS double) END AS {_f}")


def _decoded(spark, sf_dir, faults=False, replay_below=0):
    from fleetscope.sources.messages import decode_telemetry
    msgs = FX.wire_messages(telemetry(spark, sf_dir), faults=faults, replay_below=replay_below)
    return decode_telemetry(msgs)


def _table_rows(df: DataFrame) -> DataFrame:
    from fleetscope.schemas import EVENT_COLUMNS, NUMERIC_FIELDS
    cols = []
    for c in EVENT_COLUMNS:
        if c in NUMERIC_FIELDS:
            cols.append(F.col(c).cast("double").alias(c))
        elif c == "event_timestamp":
            cols.append(F.col(c).cast("timestamp_ntz").alias(c))
        else:
            cols.append(F.col(c))
    return df.select(F.col("offset").alias("event_id"), *cols)


@register("decode_telemetry", O.with_views("""
SELECT event_id, device_id, model, firmware, network_type,
       strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp,
       cast(cpu_usage_pct AS double) AS cpu_usage_pct, cast(memory_usage_pct AS double) AS memory_usage_pct,
       cast(signal_strength_dbm AS double) AS signal_strength_dbm,
       cast(throughput_mbps AS double) AS throughput_mbps, cast(battery_pct AS double) AS battery_pct,
       event_type, CAST(NULL AS varchar) AS _corrupt
FROM telemetry"""))
def q_decode(spark, sf_dir):
    """Keyed JSON messages of every reading, decoded back to fields."""
    d = _decoded(spark, sf_dir)
    return d.select(F.col("offset").alias("event_id"), *[c for c in d.columns
                                                          if c not in ("key", "partition", "offset", "_not_object")])


@register("quarantine_invalid", O.with_views(f"""
SELECT event_id, {_FAULT_CASE} AS reasons, event_id % 150 NOT IN ({_FAULT_LIST}) AS accepted
FROM telemetry"""))
def q_quarantine(spark, sf_dir):
    """Every message checked: damaged ones rejected with their reasons."""
    from fleetscope.operators.ingest import quarantine_invalid
    q = quarantine_invalid(_decoded(spark, sf_dir, faults=True))
    return q.select(F.col("offset").alias("event_id"),
                    F.concat_ws(",", "reject_reasons").alias("reasons"),
                    (F.size("reject_reasons") == 0).alias("accepted"))


@register("conform_event", O.with_views(f"""
SELECT event_id, {_EDGE_COLS_SQL} FROM telemetry WHERE event_id % 150 NOT IN ({_FAULT_LIST})"""))
def q_conform(spark, sf_dir):
    """Valid messages shaped into stored-table rows."""
    from fleetscope.operators.ingest import conform_event, quarantine_invalid, split_valid
    valid, _ = split_valid(quarantine_invalid(_decoded(spark, sf_dir, faults=True)))
    return _table_rows(conform_event(valid, keep=["offset"]))


@register("dedup_events", O.with_views(f"SELECT event_id, {_TABLE_COLS_SQL} FROM telemetry"))
def q_dedup(spark, sf_dir):
    """Redelivered messages stored once (identity = partition + offset)."""
    from fleetscope.operators.ingest import conform_event, dedup_events
    d = dedup_events(_decoded(spark, sf_dir, replay_below=10))
    return _table_rows(conform_event(d, keep=["offset"]))


@register("publish_alerts", O.with_views("""
SELECT device_id AS key, device_id, strftime(detected_at, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp, metric,
       observed_value, rolling_mean AS mean, rolling_std_dev AS std_dev, z_score, severity FROM alerts""", alerts=True))
def q_publish(spark, sf_dir):
    """Alert messages (key + JSON), decoded back for checking."""
    from fleetscope.sources.messages import decode_alerts, publish_alerts
    return decode_alerts(publish_alerts(stored_alerts(spark, sf_dir)))


@register("stamp_ingest_time", """
SELECT event_id, ts + to_microseconds(cast(round(value * 1000000) AS bigint)) AS ingested_at FROM events""")
def q_stamp(spark, sf_dir):
    """Arrival time stamped on every row (event time + delivery delay)."""
    from fleetscope.operators.ingest import stamp_ingest_time
    ev = FX.load_table(spark, sf_dir, "events")
    delay = (F.round(F.col("value") * 1_000_000).cast("long") / 1_000_000).cast("decimal(18,6)")
    return stamp_ingest_time(ev, at=F.col("ts") + F.make_dt_interval(secs=delay)).select("event_id", "ingested_at")


def _alerts_with_event_sql() -> str:
    return O.telemetry_alerts_sql(extra=["event_id"])


@register("batch_progress", O.with_views(f"""
, b AS (SELECT event_id // 200 AS batch_id, device_id FROM telemetry),
heard AS (SELECT * FROM b WHERE device_id <> '{DEVICE}'),
ev AS (SELECT batch_id, count(*) AS events FROM b GROUP BY batch_id),
an AS (SELECT event_id // 200 AS batch_id, count(*) AS anomalies FROM ({_alerts_with_event_sql()}) x
       WHERE device_id <> '{DEVICE}' GROUP BY 1),
nd AS (SELECT batch_id, count(*) AS new_devices FROM
         (SELECT device_id, min(batch_id) AS batch_id FROM heard GROUP BY device_id) f GROUP BY batch_id)
SELECT ev.batch_id, events, coalesce(anomalies, 0) AS anomalies,
       cast(sum(events) OVER (ORDER BY ev.batch_id) AS bigint) AS total_processed,
       cast(sum(coalesce(anomalies, 0)) OVER (ORDER BY ev.batch_id) AS bigint) AS total_anomalies,
       cast(sum(coalesce(new_devices, 0)) OVER (ORDER BY ev.batch_id) AS bigint) AS devices_tracked
FROM ev LEFT JOIN an ON ev.batch_id = an.batch_id LEFT JOIN nd ON ev.batch_id = nd.batch_id"""))
def q_batch_progress(spark, sf_dir):
    """Per flush of 200 events (arrival order): counts and running totals.
    One device sends readings without any metric and is not tracked."""
    from fleetscope.operators.progress import batch_progress
    t = telemetry(spark, sf_dir)
    t = t.withColumns({m: F.when(F.col("device_id") != DEVICE, F.col(m)) for m in D.MONITORED_METRICS})
    a = D.detect_anomalies(t, keep=["event_id"])
    batch = (F.col("event_id") / 200).cast("long")
    return batch_progress(t.withColumn("batch_id", batch), a.withColumn("batch_id", batch))


# ---------------------------------------------------------------- streams
def _stream_source(spark, sf_dir, replay_below: int = 0, chunks: int = 3, part: str = "all",
                   faults: bool = False) -> dict:
    """Message files of every reading (3 ordered chunks, one per trigger),
    written once per application and data folder, and a fresh folder of the
    session's shared checkpoint dir for what the stream writes. ``part``:
    readings that lack fields (``partial``), three fifths of them (``early``) or all, a fifth
    after the others (``late``)."""
    from fleetscope.session import new_subdir
    files = FX.chunk_files(FX.load_table(spark, sf_dir, "events").count(), chunks)

    def write(path: str) -> None:
        view = telemetry(spark, sf_dir)
        view = FX.partial_view(view) if part == "partial" else view.where("event_id % 5 > 1") if part == "early" else view
        if part == "late":
            behind = view.agg(F.max("event_id").alias("n"))
            view = view.join(F.broadcast(behind)).withColumn("event_id", F.expr(
                "CASE WHEN event_id % 5 = 1 THEN event_id + n + 1 ELSE event_id END")).drop("n")
        FX.write_wire_chunks(FX.wire_messages(view, faults=faults, replay_below=replay_below), path, chunks=chunks, files=files)

    path = _stored(spark, sf_dir, f"messages-{part}-{replay_below}-{chunks}-{faults}", write)
    return {"path": path, "options": {"maxFilesPerTrigger": str(files)}, "_files": files, "_root": new_subdir(spark, "stream")}


def _src(d: dict) -> dict:
    return {k: v for k, v in d.items() if not k.startswith("_")}


class state_partitions:
    """Start streams with one state partition per core of the cluster (the
    number is fixed in the checkpoint at the first start); the session's
    setting is restored afterwards."""

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.old = self.spark.conf.get("spark.sql.shuffle.partitions")
        try:
            n = max(2, self.spark.sparkContext.defaultParallelism)
        except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): keep the setting
            n = int(self.old)
        self.spark.conf.set("spark.sql.shuffle.partitions", str(n))
        return self

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.shuffle.partitions", self.old)
        return False


@register("detect_anomalies_stream", O.telemetry_alerts_sql())
def q_detect_stream(spark, sf_dir):
    """Keyed-state detection over the message stream (3 micro-batches,
    with redelivered messages); equals the batch alerts."""
    from fleetscope.streaming.jobs import run_to_end, start_alerts_query
    from fleetscope.streaming.sinks import read_alerts
    s = _stream_source(spark, sf_dir, replay_below=10)
    with state_partitions(spark):
        run_to_end(start_alerts_query(spark, _src(s), f"{s['_root']}/alerts", f"{s['_root']}/_ck_alerts"))
    a = read_alerts(spark, f"{s['_root']}/alerts")
    return a.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "detected_at" else F.col(c)
                      for c in ALERT_COLUMNS])


@register("detect_anomalies_stream_split", O.telemetry_alerts_sql())
def q_detect_stream_split(spark, sf_dir):
    """The same by micro-batch, with blocks of 20 readings in a micro-batch: every device is cut over several tasks and
    continues from the tail that the batches before left."""
    from fleetscope.streaming.jobs import run_to_end, start_split_alerts_query
    from fleetscope.streaming.sinks import read_alerts
    s = _stream_source(spark, sf_dir, replay_below=10)
    with state_partitions(spark):
        run_to_end(start_split_alerts_query(spark, _src(s), f"{s['_root']}/alerts", f"{s['_root']}/_ck_alerts",
                                            target_rows=20, full_every=2))
    a = read_alerts(spark, f"{s['_root']}/alerts")
    return a.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "detected_at" else F.col(c)
                      for c in ALERT_COLUMNS])


def _stored_rows(df: DataFrame) -> DataFrame:
    """Stored events -> the oracle's column types (doubles, NTZ time)."""
    from fleetscope.schemas import NUMERIC_FIELDS
    return df.select(F.col("offset").alias("event_id"), "device_id", "model", "firmware", "network_type",
                     F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
                     *[F.col(c).cast("double").alias(c) for c in NUMERIC_FIELDS], "event_type")


@register("write_events_by_month", O.with_views(f"SELECT event_id, {_TABLE_COLS_SQL} FROM telemetry"))
def q_write_events(spark, sf_dir):
    """Message stream -> month-partitioned event table (with replays,
    stored once), read back."""
    from fleetscope.streaming.jobs import run_to_end, start_events_query
    s = _stream_source(spark, sf_dir, replay_below=10)
    with state_partitions(spark):
        run_to_end(start_events_query(spark, _src(s), f"{s['_root']}/events", f"{s['_root']}/_ck_events"))
    return _stored_rows(spark.read.parquet(f"{s['_root']}/events"))


@register("dedup_stream", O.with_views(f"SELECT event_id, {_EDGE_COLS_SQL} FROM telemetry "
                                       f"WHERE event_id % 150 NOT IN ({_FAULT_LIST})"))
def q_dedup_stream(spark, sf_dir):
    """Messages whose own timestamps run backwards by more than the dedup
    horizon, some of them redelivered, some damaged: every good one is
    stored, once."""
    from fleetscope.streaming.jobs import run_to_end, start_events_query
    s = _stream_source(spark, sf_dir, replay_below=30, faults=True)
    with state_partitions(spark):
        run_to_end(start_events_query(spark, _src(s), f"{s['_root']}/events", f"{s['_root']}/_ck_events"))
    return _stored_rows(spark.read.parquet(f"{s['_root']}/events"))


@register("insert_once_stream", O.with_views(f"SELECT event_id, {_TABLE_COLS_SQL} FROM telemetry"))
def q_insert_once(spark, sf_dir):
    """Every message of an earlier run is delivered again after a restart,
    with others among them that come for the first time, out of order: each
    is stored once."""
    from fleetscope.streaming.jobs import run_to_end, start_events_query
    early, every = (_stream_source(spark, sf_dir, part=part, replay_below=8) for part in ("early", "all"))
    root = early["_root"]
    # one log: the messages of the first source, and those of the second, which has them all once more
    from fleetscope.sources.messages import MESSAGE_FILE_SCHEMA
    many = -(-every["_files"] // FX.FILES)  # files grow in number with the messages
    for s in (early, every):
        (spark.read.schema(MESSAGE_FILE_SCHEMA).json(s["path"]).repartition(6 * many, F.col("offset") % (6 * many))
         .write.mode("append").option("compression", "gzip").json(f"{root}/log"))
        with state_partitions(spark):
            run_to_end(start_events_query(spark, {"path": f"{root}/log", "options": {"maxFilesPerTrigger": str(2 * many)}},
                                          f"{root}/events", f"{root}/_ck_events"))
    return _stored_rows(spark.read.parquet(f"{root}/events"))


_PARTIAL_SQL = f"""(SELECT * REPLACE (
  CASE WHEN event_id % 7 <> 3 THEN cpu_usage_pct END AS cpu_usage_pct,
  CASE WHEN event_id % 11 <> 5 THEN signal_strength_dbm END AS signal_strength_dbm)
  FROM ({O.TELEMETRY_SQL}) tv) pv"""


@register("detect_anomalies_stream_partial", O.alerts_sql(
    _PARTIAL_SQL, "device_id", "event_timestamp", ["event_timestamp", "event_id"], O.METRICS, O.THRESHOLDS))
def q_detect_stream_partial(spark, sf_dir):
    """Readings that lack a metric, the battery or the model are scored on
    the metrics they have, and published."""
    from fleetscope.streaming.jobs import run_to_end, start_alerts_query
    from fleetscope.streaming.sinks import read_alerts
    s = _stream_source(spark, sf_dir, replay_below=10, part="partial")
    with state_partitions(spark):
        run_to_end(start_alerts_query(spark, _src(s), f"{s['_root']}/alerts", f"{s['_root']}/_ck_alerts",
                                      publish={"path": f"{s['_root']}/published"}))
    a = read_alerts(spark, f"{s['_root']}/alerts")
    return a.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "detected_at" else F.col(c)
                      for c in ALERT_COLUMNS])


_SPIKED = "l_extendedprice + CASE WHEN l_orderkey % 1000 = 7 THEN 10000000000.0 ELSE 0.0 END"


@register("detect_anomalies_stream_general", f"""
SELECT device_id, l_shipdate, l_orderkey, l_linenumber, severity FROM (
  SELECT *, CASE WHEN z >= 2.5 THEN 'critical' WHEN z >= 1.8 THEN 'warning' END AS severity FROM (
    SELECT *, CASE WHEN n >= 30 AND sd >= 1e-6 THEN abs(x - mean) / sd END AS z FROM (
      SELECT *, count(*) OVER w AS n, avg(x) OVER w AS mean, stddev_pop(x) OVER w AS sd FROM (
        SELECT cast(l_suppkey AS varchar) AS device_id, l_shipdate, l_orderkey, l_linenumber, {_SPIKED} AS x
        FROM lineitem) v
      WINDOW w AS (PARTITION BY device_id ORDER BY l_shipdate, l_orderkey, l_linenumber
                   ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)) s) z) t
WHERE severity IS NOT NULL""")
def q_detect_stream_general(spark, sf_dir):
    """Keyed-state detection on doubles: prices with spikes of 1e10, after
    which the windows' numbers are as exact as before."""
    from fleetscope.session import new_subdir
    from fleetscope.streaming.detect_stream import detect_anomalies_stream
    root = new_subdir(spark, "stream")
    src = FX.load_table(spark, sf_dir, "lineitem")
    # as a pattern, which the stream's reader takes for a file and for a folder
    rows = spark.readStream.schema(src.schema).parquet(f"{sf_dir.rstrip('/')}/lineitem.parque[t]")
    rows = rows.select(F.col("l_suppkey").cast("string").alias("device_id"), *FX.LINEITEM_ORDER,
                       F.expr(_SPIKED).alias("price"))
    found = detect_anomalies_stream(rows, time_col="l_shipdate", order_cols=FX.LINEITEM_ORDER, metrics=["price"],
                                    thresholds={"price": (1.8, 2.5)}, exact=False, keep=["l_orderkey", "l_linenumber"])
    with state_partitions(spark):
        (found.writeStream.format("parquet").option("path", f"{root}/alerts").outputMode("append")
         .option("checkpointLocation", f"{root}/_ck").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(found.schema).parquet(f"{root}/alerts").select(
        "device_id", F.col("detected_at").alias("l_shipdate"), "l_orderkey", "l_linenumber", "severity")


@register("telemetry_source", O.with_views("""
SELECT event_id AS offset, device_id AS key, TRUE AS one_partition,
       concat('{"device_id":"', device_id, '","model":"', model, '","firmware":"', firmware, '","network_type":"', network_type,
              '","timestamp":"', strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f+00:00'),
              '","cpu_usage_pct":', cast(cpu_usage_pct AS double), ',"memory_usage_pct":', cast(memory_usage_pct AS double),
              ',"signal_strength_dbm":', cast(signal_strength_dbm AS double), ',"throughput_mbps":',
              cast(throughput_mbps AS double), ',"battery_pct":', cast(battery_pct AS double), ',"event_type":"', event_type,
              '"}') AS value
FROM telemetry"""))
def q_source(spark, sf_dir):
    """Every message of the source read once, in micro-batches: key, value
    and offset, and whether all of a key's messages share a partition."""
    from fleetscope.sources.messages import telemetry_source
    s = _stream_source(spark, sf_dir)
    out = telemetry_source(spark, **_src(s)).select(
        F.col("offset"), F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "partition")
    q = (out.writeStream.format("parquet").option("path", f"{s['_root']}/raw")
         .option("checkpointLocation", f"{s['_root']}/_ck_raw").trigger(availableNow=True).start())
    q.awaitTermination()
    raw = spark.read.parquet(f"{s['_root']}/raw")
    keys = raw.groupBy("key").agg(((F.min("partition") == F.max("partition")) & (F.min("partition") >= 0)
                                   & (F.max("partition") < 6)).alias("one_partition"))
    return raw.join(keys, "key").select("offset", "key", "value", "one_partition")


@register("refresh_rollup", _ROLLUP_SQL)
def q_refresh(spark, sf_dir):
    """Stored events -> versioned rollup in three refreshes: the committed
    batches of a stream, then two further runs whose events are late (they
    lie before and among those already folded in)."""
    from fleetscope.plans.refresh import read_rollup, refresh_rollup
    from fleetscope.streaming.jobs import run_to_end, start_events_query
    from fleetscope.streaming.sinks import write_events_by_month
    t = telemetry(spark, sf_dir)
    late = F.col("event_id") % 5
    s = _stream_source(spark, sf_dir, part="early")
    events, rollup = f"{s['_root']}/events", f"{s['_root']}/rollup"
    with state_partitions(spark):
        run_to_end(start_events_query(spark, _src(s), events, f"{s['_root']}/_ck_events"))
    refresh_rollup(spark, events, rollup, checkpoint=f"{s['_root']}/_ck_events")
    for k in (0, 1):
        rows = t.where(late == k).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
        write_events_by_month(rows, 0, events, extra=[], run_id=f"late-{k}")
        refresh_rollup(spark, events, rollup)
    return read_rollup(spark, rollup).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register("rollup_5min_stream", f"""
WITH r AS ({_ROLLUP_SQL})
SELECT * FROM r WHERE window_start + INTERVAL 5 MINUTE
                      <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def q_rollup_stream(spark, sf_dir):
    """Rollup as a stream: windows the watermark (max time - 10 min) has
    passed are emitted once, in append mode; redelivered messages count once."""
    from fleetscope.streaming.jobs import run_to_end, start_rollup_query
    s = _stream_source(spark, sf_dir, replay_below=10)
    with state_partitions(spark):
        run_to_end(start_rollup_query(spark, _src(s), f"{s['_root']}/rollup", f"{s['_root']}/_ck_rollup"))
    r = spark.read.parquet(f"{s['_root']}/rollup")
    return r.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register("rollup_5min_late_stream", _ROLLUP_SQL)
def q_rollup_late_stream(spark, sf_dir):
    """A fifth of the readings arrives long after the watermark has passed
    their windows, some twice: the windows are corrected, none is trimmed."""
    from fleetscope.streaming.jobs import run_to_end, start_late_rollup_query
    from fleetscope.streaming.rollup_batches import read_rollup_batches
    s = _stream_source(spark, sf_dir, part="late", replay_below=10)
    with state_partitions(spark):
        run_to_end(start_late_rollup_query(spark, _src(s), f"{s['_root']}/rollup", f"{s['_root']}/_ck_rollup"))
    r = read_rollup_batches(spark, f"{s['_root']}/rollup")
    return r.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register("write_anomaly_alerts", O.telemetry_alerts_sql())
def q_write_alerts(spark, sf_dir):
    """Batch alerts written through the alert sink twice under the same
    batch id (a replay), read back: stored once, NUMERIC(10,4)/(8,4)."""
    from fleetscope.session import new_subdir
    from fleetscope.streaming.sinks import read_alerts, write_anomaly_alerts
    root = new_subdir(spark, "alerts")
    a = alerts(spark, sf_dir)
    write_anomaly_alerts(a, 0, f"{root}/alerts")
    write_anomaly_alerts(a, 0, f"{root}/alerts")
    return read_alerts(spark, f"{root}/alerts").select(*ALERT_COLUMNS)


@register("quarantine_stream", O.with_views(f"""
SELECT event_id, reasons FROM (SELECT event_id, {_FAULT_CASE} AS reasons FROM telemetry) r
WHERE event_id % 150 IN ({_FAULT_LIST})"""))
def q_quarantine_stream(spark, sf_dir):
    """Damaged messages through the stream's quarantine sink (rejected
    rows with reasons), read back."""
    from fleetscope.streaming.jobs import run_to_end, start_quarantine_query
    s = _stream_source(spark, sf_dir, faults=True)
    with state_partitions(spark):
        run_to_end(start_quarantine_query(spark, _src(s), f"{s['_root']}/rejected", f"{s['_root']}/_ck_rejected"))
    return spark.read.parquet(f"{s['_root']}/rejected").select(F.col("offset").alias("event_id"), "reasons")
