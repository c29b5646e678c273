"""DuckDB SQL for every checked query (the correctness oracle).

These strings are written independently of the Spark code: they use the
direct per-key window (no blocks), plain SQL aggregation and sorting.
Tables ``events``, ``lineitem`` ... are views the checker registers.
"""

from __future__ import annotations

# Fixed values, stated again so that the oracle does not follow the code under test.
METRICS = ["cpu_usage_pct", "signal_strength_dbm", "throughput_mbps", "memory_usage_pct"]
THRESHOLDS = {"cpu_usage_pct": (2.0, 3.0), "signal_strength_dbm": (1.8, 2.5), "throughput_mbps": (1.8, 2.5),
              "memory_usage_pct": (2.2, 3.2)}
WINDOW_SIZE = 60

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

TELEMETRY_SQL = """
SELECT *, CASE
  WHEN cpu_usage_pct > 85 OR signal_strength_dbm < -105 OR throughput_mbps < 10 THEN 'critical'
  WHEN cpu_usage_pct > 70 OR signal_strength_dbm < -90 OR throughput_mbps < 50 THEN 'degraded'
  ELSE 'normal' END AS event_type
FROM (
 SELECT event_id, concat('DEV-', lpad(cast(user_id AS varchar), 5, '0')) AS device_id,
  concat('tracker-', chr(97 + cast(user_id % 7 AS int))) AS model,
  concat('v', cast(10 + user_id % 6 AS varchar), '.', cast(user_id % 10 AS varchar), '.0') AS firmware,
  CASE WHEN user_id % 3 = 0 THEN 'wifi' ELSE 'mesh' END AS network_type,
  ts AS event_timestamp,
  cast(CASE WHEN j = 0 THEN 95 WHEN j = 75 THEN 75 ELSE 20 + (k * 25) / 100.0 END AS decimal(5,2)) AS cpu_usage_pct,
  cast(40 + ((event_id * 131) % 2501) / 100.0 AS decimal(5,2)) AS memory_usage_pct,
  cast(CASE WHEN j = 50 THEN -112 ELSE -82 + ((event_id * 37) % 2001) / 100.0 END AS decimal(6,2)) AS signal_strength_dbm,
  cast(CASE WHEN j = 50 THEN 5 WHEN j = 100 THEN 2 ELSE 160 + least(value, 800.0) END AS decimal(8,2)) AS throughput_mbps,
  cast(20 + (event_id * 13) % 81 AS decimal(5,2)) AS battery_pct
 FROM (SELECT event_id, user_id, ts, value, cast(json_extract_string(props, '$.k') AS int) AS k,
              event_id % 150 AS j FROM events) e
) m
"""

LINEITEM_METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def half_up_sql(num: str, den: str) -> str:
    return (f"(CASE WHEN ({num}) < 0 THEN -((2 * abs({num}) + ({den})) // (2 * ({den}))) "
            f"ELSE (2 * abs({num}) + ({den})) // (2 * ({den})) END)")


def window_stats_sql(src: str, device: str, order: list[str], metrics: list[str],
                     ids: list[str], window: int = WINDOW_SIZE) -> str:
    """Long form (device_id, ids..., metric, c) + n, s, q over the last `window` rows."""
    parts = []
    for m in metrics:
        parts.append(f"SELECT {device} AS device_id, {', '.join(ids)}, '{m}' AS metric, "
                     f"cast(round(cast({m} AS double) * 100) AS bigint) AS c FROM {src} WHERE {m} IS NOT NULL")
    u = " UNION ALL ".join(parts)
    return f"""
SELECT *, count(*) OVER win AS n, cast(sum(c) OVER win AS bigint) AS s,
       cast(sum(c * c) OVER win AS bigint) AS q
FROM ({u}) u
WINDOW win AS (PARTITION BY device_id, metric ORDER BY {', '.join(order)}
               ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)
"""


def thresholds_case(thresholds: dict, idx: int) -> str:
    whens = " ".join(f"WHEN '{m}' THEN {t[idx]}" for m, t in thresholds.items())
    return f"(CASE metric {whens} END)"


def scored_sql(stats_sql: str, window: int = WINDOW_SIZE) -> str:
    return f"""
SELECT *, CASE WHEN n >= {window // 2} AND root / (n * 100) >= 1e-6
               THEN cast(abs(n * c - s) AS double) / root END AS z,
          root / (n * 100) AS std
FROM (SELECT *, sqrt(cast(n::hugeint * q - s::hugeint * s AS double)) AS root FROM ({stats_sql}) w) r
"""


def alerts_sql(src: str, device: str, time_col: str, order: list[str], metrics: list[str],
               thresholds: dict, window: int = WINDOW_SIZE, extra: list[str] | None = None) -> str:
    extra = extra or []
    ids = list(dict.fromkeys([*(o.split()[0] for o in order), time_col]))
    stats = window_stats_sql(src, device, order, metrics, ids, window)
    sc = scored_sql(stats, window)
    crit, warn = thresholds_case(thresholds, 1), thresholds_case(thresholds, 0)
    mean4 = half_up_sql("s * 100", "n")
    extra_sel = "".join(f", {e}" for e in extra)
    return f"""
SELECT device_id, detected_at, metric, observed_value, rolling_mean, rolling_std_dev, z_score, severity{extra_sel}
FROM (
 SELECT device_id, {time_col} AS detected_at, metric, cast(c AS double) / 100 AS observed_value,
        cast({mean4} AS double) / 10000 AS rolling_mean, round(std, 4) AS rolling_std_dev,
        round(z, 4) AS z_score,
        CASE WHEN z >= {crit} THEN 'critical' WHEN z >= {warn} THEN 'warning' END AS severity{extra_sel}
 FROM ({sc}) t WHERE z IS NOT NULL
) a WHERE severity IS NOT NULL
"""


def telemetry_alerts_sql(extra: list[str] | None = None) -> str:
    return alerts_sql(f"({TELEMETRY_SQL}) tv", "device_id", "event_timestamp",
                      ["event_timestamp", "event_id"], METRICS, THRESHOLDS,
                      extra=extra)


def lineitem_alerts_sql() -> str:
    th = {m: (1.8, 2.5) for m in LINEITEM_METRICS}
    return alerts_sql("lineitem", "cast(l_suppkey AS varchar)", "l_shipdate",
                      ["l_shipdate", "l_orderkey", "l_linenumber"], LINEITEM_METRICS, th)


def with_views(body: str, alerts: bool = False) -> str:
    """Prefix a query on `telemetry` (and `alerts`) with their CTEs."""
    ctes = [f"telemetry AS ({TELEMETRY_SQL})"]
    if alerts:
        ctes.append(f"alerts AS ({telemetry_alerts_sql()})")
    sep = "" if body.lstrip().startswith(",") else "\n"
    return "WITH " + ",\n".join(ctes) + sep + body
