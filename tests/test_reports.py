"""Percentiles against a brute-force computation; plan shapes of reports."""
import random
import statistics

from fleetscope.operators import reports as R


def test_percentiles_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for g in range(6):
        n = [1, 2, 19, 20, 101, 3000][g]  # odd/even, tiny, one dominant group
        for _ in range(n):
            rows.append((f"g{g}", round(rng.choice([rng.uniform(0, 50), 12.5, 3.0]), 3)))
    df = spark.createDataFrame(rows, "device_id string, lag_ms double")
    got = {r.device_id: r for r in R.ingest_lag_percentiles(df, ["device_id"], widths=(0.7 * 64, 0.7)).collect()}
    for g in sorted(got):
        vals = sorted(v for k, v in rows if k == g)
        n = len(vals)
        r = got[g]
        assert r.n == n
        assert abs(r.p50 - statistics.median(vals)) < 1e-9
        assert r.p95 == vals[int(n * 0.95)]
        assert r.p99 == vals[int(n * 0.99)]


def test_fleet_topk_uses_partial_group_limit(spark):
    from conftest import SF_SMALL
    from fleetscope.sources.fixtures import load_telemetry
    t = load_telemetry(spark, SF_SMALL)
    plan = R.device_metrics_fleet(t, as_of="2024-01-31 00:00:00", since_minutes=1440, limit=3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text or "Partial" in text


def test_device_summary_is_take_ordered(spark):
    from conftest import SF_SMALL
    from fleetscope.sources.fixtures import load_telemetry
    text = R.device_summary(load_telemetry(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text
