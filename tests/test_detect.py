"""Sliding-window statistics against their definition."""
import math
from fractions import Fraction

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetscope.operators import detect as D
from fleetscope.operators import blocks as B
from fleetscope.operators.blocks import assign_blocks
from fleetscope.schemas import THRESHOLDS


def expected_alerts(rows, window, thresholds):
    """rows: (device, t, metric, value or None) in arrival order. Mean and
    population variance of the last ``window`` values, as fractions; z is
    compared as z^2, so that nothing is rounded."""
    seen, out = {}, set()
    for dev, t, metric, x in rows:
        if x is None:
            continue
        held = seen.setdefault((dev, metric), [])
        held.append(Fraction(round(x * 100), 100))
        last = held[-window:]
        n = len(last)
        mean = sum(last) / n
        var = sum((v - mean) ** 2 for v in last) / n
        if n < window // 2 or var < Fraction(1, 10 ** 12):
            continue
        z2 = (last[-1] - mean) ** 2 / var
        warn, crit = (Fraction(str(v)) ** 2 for v in thresholds[metric])
        if z2 >= warn:
            out.add((dev, t, metric, "critical" if z2 >= crit else "warning", z2))
    return out


values = st.one_of(st.none(), st.integers(min_value=-500, max_value=500).map(lambda c: c / 100),
                   st.sampled_from([1.0, 1.0, 1.0, 5.0]))


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(seq=st.lists(st.tuples(st.integers(0, 2), values), min_size=1, max_size=150),
       window=st.sampled_from([1, 2, 3, 5, 60]),
       target=st.sampled_from([1, 7, 40, 10_000]))
def test_alerts_match_definition(spark, seq, window, target):
    th = {"cpu_usage_pct": (1.5, 2.0)}
    rows = [(f"d{d}", i, "cpu_usage_pct", x) for i, (d, x) in enumerate(seq)]
    pdf = pd.DataFrame({"device_id": [r[0] for r in rows], "event_id": [r[1] for r in rows],
                        "cpu_usage_pct": [r[3] for r in rows]})
    df = spark.createDataFrame(pdf, "device_id string, event_id long, cpu_usage_pct double")
    df = df.withColumn("ts", F.col("event_id"))
    got = D.detect_anomalies(df, time_col="ts", order_cols=["ts", "event_id"], metrics=["cpu_usage_pct"],
                             thresholds=th, window=window, target_rows=target).collect()
    got = {(r.device_id, r.detected_at, r.metric, r.severity) for r in got}
    want = expected_alerts(rows, window, th)
    # where z equals a threshold as a number, its double may be just below it
    ties = {w[:3] for w in want if w[4] in (Fraction(9, 4), Fraction(4))}
    want = {w[:4] for w in want}
    assert {g for g in got ^ want if g[:3] not in ties} == set()


LINEITEM_KEY = ["device_id", "detected_at", "metric", "severity", "z_score", "rolling_mean", "rolling_std_dev"]


def _lineitem_alerts(spark, target_rows):
    from fleetscope.sources.fixtures import LINEITEM_METRICS, LINEITEM_ORDER, load_lineitem_history
    from conftest import SF_SMALL
    li = load_lineitem_history(spark, SF_SMALL)
    return D.detect_anomalies(li, time_col="l_shipdate", order_cols=LINEITEM_ORDER,
                              metrics=LINEITEM_METRICS, thresholds={m: (1.8, 2.5) for m in LINEITEM_METRICS},
                              target_rows=target_rows)


@pytest.mark.parametrize("target", [1, 90, 250])
def test_block_size_does_not_change_results(spark, target):
    want = sorted(map(tuple, _lineitem_alerts(spark, 10 ** 9).select(*LINEITEM_KEY).collect()))
    got = sorted(map(tuple, _lineitem_alerts(spark, target).select(*LINEITEM_KEY).collect()))
    assert len(want) == 428 and got == want


def test_one_shuffle_of_readings_and_one_of_edges(spark):
    df = _lineitem_alerts(spark, 150)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("== Initial Plan ==")]
    shuffles = [x for x in final.splitlines() if " Exchange hashpartitioning" in x and "Reused" not in x]
    assert len(shuffles) == 2, final
    assert sum("REPARTITION_BY_COL" in x for x in shuffles) == 1


def test_blocks_split_sparse_rates_bursts_and_ties(spark):
    """Blocks hold about the wanted rows at one row per 5 minutes and in a
    burst within a second; only rows equal in all order columns stay together."""
    slow = [("slow", 300 * i, i) for i in range(1000)]
    burst = [("burst", 7, i) for i in range(1000)]
    few = [("few", i, i) for i in range(10)]
    df = spark.createDataFrame(slow + burst + few, "k string, s long, id long").select(
        "k", F.timestamp_seconds("s").alias("ts"), "id")
    got = assign_blocks(df, ["k"], ["ts", "id"], 100).groupBy("k", "_blk").agg(
        F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).collect()
    for k in ("slow", "burst"):
        own = sorted((r for r in got if r.k == k), key=lambda r: r._blk)
        assert 9 <= len(own) <= 10 and max(r.n for r in own) <= 200
        assert all(a.hi < b.lo for a, b in zip(own, own[1:]))
    assert [(r._blk, r.n) for r in got if r.k == "few"] == [(0, 10)]


def test_values_finer_than_the_scale_are_refused(spark):
    df = spark.createDataFrame([("a", i, i + 0.125) for i in range(40)], "device_id string, event_id long, cpu_usage_pct double")
    df = df.withColumn("ts", F.col("event_id"))
    kw = dict(time_col="ts", metrics=["cpu_usage_pct"], thresholds={"cpu_usage_pct": (1.0, 2.0)})
    with pytest.raises(Exception, match="multiple of 1/100"):
        D.detect_anomalies(df, **kw).collect()
    with pytest.raises(ValueError):
        D.detect_anomalies(df, scale=7, **kw)
    assert D.detect_anomalies(df, scale=1000, **kw).count() == D.detect_anomalies(df, exact=False, **kw).count() > 0


def test_window_one_never_alerts(spark):
    df = spark.createDataFrame([("a", i, float(i % 7)) for i in range(50)], "device_id string, event_id long, cpu_usage_pct double")
    out = D.detect_anomalies(df.withColumn("ts", F.col("event_id")), time_col="ts", metrics=["cpu_usage_pct"],
                             thresholds={"cpu_usage_pct": THRESHOLDS["cpu_usage_pct"]}, window=1)
    assert out.count() == 0


def test_ready_at_half_window(spark):
    # 29 flat readings then a spike: not ready (n = 29 < 30 with the spike? n = 30 -> ready)
    vals = [10.0] * 28 + [11.0, 50.0]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(vals)], "device_id string, event_id long, cpu_usage_pct double")
    out = D.detect_anomalies(df.withColumn("ts", F.col("event_id")), time_col="ts", metrics=["cpu_usage_pct"],
                             thresholds={"cpu_usage_pct": (2.0, 3.0)}).collect()
    assert [r.event_id if hasattr(r, "event_id") else r.detected_at for r in out] == [29]
    assert out[0].severity == "critical"
    # |z| <= sqrt(n - 1) with the current reading in the window
    assert out[0].z_score <= math.sqrt(29) + 1e-9
    vals = vals[1:]  # now n = 29 at the spike -> not ready
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(vals)], "device_id string, event_id long, cpu_usage_pct double")
    out = D.detect_anomalies(df.withColumn("ts", F.col("event_id")), time_col="ts", metrics=["cpu_usage_pct"],
                             thresholds={"cpu_usage_pct": (2.0, 3.0)})
    assert out.count() == 0


def test_general_form_matches_exact(spark):
    from conftest import SF_SMALL
    from fleetscope.sources.fixtures import load_telemetry
    t = load_telemetry(spark, SF_SMALL)
    a = {(r.device_id, r.detected_at, r.metric, r.severity) for r in D.detect_anomalies(t).collect()}
    b = {(r.device_id, r.detected_at, r.metric, r.severity) for r in D.detect_anomalies(t, exact=False).collect()}
    assert a == b and len(a) == 47


@pytest.mark.parametrize("target", [1_000_000, 90])
@pytest.mark.parametrize("window", [3, 512, 700])
def test_large_windows_by_running_sums(spark, monkeypatch, window, target):
    """The same numbers as a bounded frame, at the limits of the type too."""
    rows = [("d", i, (999_999.99 if i % 3 else -999_999.99) + i % 7 / 100) for i in range(2000)]
    rows += [("e", i, 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, i long, x double")
    monkeypatch.setattr(D, "PREFIX_SUMS_FROM", 2)
    got = D.rolling_stats(df, ["k"], ["i"], window=window, target_rows=target).collect()
    values = {}
    for k, i, x in rows:
        values.setdefault(k, []).append(round(x * 100))
    for r in got:
        last = values[r.k][max(0, r.i - window + 1):r.i + 1]
        assert (r.n, r.s, int(r.q)) == (len(last), sum(last), sum(v * v for v in last))
    assert len(got) == len(rows)


def test_values_at_the_limits_in_batch_and_stream_numbers(spark):
    from fleetscope.streaming.detect_stream import _score_metric
    import numpy as np
    x = [99_999_999 if i % 2 else -99_999_999 for i in range(90)]
    df = spark.createDataFrame([("d", i, v / 100) for i, v in enumerate(x)], "device_id string, t long, cpu_usage_pct double")
    st = D.rolling_stats(df.withColumnRenamed("cpu_usage_pct", "x"), ["device_id"], ["t"])
    batch = {r.t: r.z for r in D.zscore_guarded(st).collect()}
    _, n, s, mean, z, std = _score_metric(np.zeros(0, np.int64), np.array(x), 60, 100, True)
    assert all(math.isclose(batch[i], z[i]) for i in range(29, 90)) and s.dtype == np.int64


@pytest.mark.parametrize("target", [7, 70, 150, 10_000])
def test_null_order_values_are_split_like_others(spark, target):
    rows = [("d" if i % 4 else None, None if i % 5 == 0 else i // 3, i, (i * 37 % 101 + (900 if i % 53 == 0 else 0)) / 1.0)
            for i in range(600)]
    df = spark.createDataFrame(rows, "device_id string, t long, event_id long, cpu_usage_pct double")
    run = lambda n: sorted(map(tuple, D.detect_anomalies(
        df, time_col="event_id", order_cols=["t", "event_id"], metrics=["cpu_usage_pct"], target_rows=n).collect()), key=str)
    assert run(target) == run(10 ** 9) and len(run(target)) > 5
    sizes = [r["count"] for r in assign_blocks(df, ["device_id"], ["t", "event_id"], target).groupBy("device_id", "_blk").count().collect()]
    assert max(sizes) <= 2 * target


def test_small_blocks_shuffle_events_twice_and_nothing_else(spark, monkeypatch):
    """Blocks of fewer rows than the window: no table with a row per bucket is written or joined to the readings, and both
    shuffles are of events, not of events by metric."""
    rows = [(f"d{i % 5}", None if i % 7 < 2 else i, i, float(i * 37 % 101), float(i * 13 % 17), i % 3 / 4, 1.0) for i in range(2000)]
    names = ["m1", "m2", "m3", "m4"]
    df = spark.createDataFrame(rows, "device_id string, t long, event_id long, " + ", ".join(f"{m} double" for m in names))
    tables = []
    monkeypatch.setattr(B, "written", lambda table, name, f=B.written: tables.append(f(table, name)) or tables[-1])
    out = D.detect_anomalies(df, time_col="event_id", order_cols=["t", "event_id"], metrics=names,
                             thresholds={m: (1.6, 2.0) for m in names}, target_rows=20)
    assert len(out.collect()) > 100
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("== Initial Plan ==")]
    shuffles = [x for x in final.splitlines() if " Exchange hashpartitioning" in x and "Reused" not in x]
    assert len(shuffles) == 2 and not any("metric" in x for x in shuffles), final
    assert "Join" not in final and tables == []


@pytest.mark.parametrize("part_rows, target, window, exact", [
    (10 ** 6, 7, 60, True), (300, 50, 60, True), (300, 7, 60, False), (60, 50, 9, True), (40, 7, 5, True)])
def test_small_blocks_in_parts_give_the_same_alerts(spark, monkeypatch, part_rows, target, window, exact):
    """Null devices, order values and readings, a metric with fewer readings than a window over many blocks, repeated rows."""
    rows = [("d" if i % 4 else None, None if i % 5 == 0 else i // 3, i, (i * 37 % 101 + (900 if i % 53 == 0 else 0)) / 4,
             float(i * i % 23 + (60 if i % 222 == 0 else 0)) if i % 31 == 0 else None) for i in range(4000)]
    rows += [("e", 1, i, None if i % 3 else float(i), 2.0) for i in range(5)] + [("f", 3, 7, 2.5, 1.0)] * 400
    names = ["m1", "m2"]
    df = spark.createDataFrame(rows, "device_id string, t long, event_id long, m1 double, m2 double").repartition(5)
    run = lambda n: sorted(map(tuple, D.detect_anomalies(
        df, time_col="event_id", order_cols=["t", "event_id"], metrics=names, thresholds={m: (1.6, 2.0) for m in names},
        window=window, exact=exact, target_rows=n, keep=["t"]).select("device_id", "detected_at", "metric", "severity", "t").collect()), key=str)
    want = run(10 ** 9)
    monkeypatch.setattr(B, "PART_ROWS", part_rows)
    assert run(target) == want and {x[2] for x in want} == set(names)


@pytest.mark.parametrize("part_rows", [100, 10 ** 6])
def test_dealt_blocks_are_runs_of_rows_in_one_task(spark, monkeypatch, part_rows):
    monkeypatch.setattr(B, "PART_ROWS", part_rows)
    rows = [("d" if i % 4 else None, None if i % 5 == 0 else i // 3, i) for i in range(2000)] + [("e", i, i) for i in range(20)]
    rows += [("same", 1, 1)] * 90
    df = spark.createDataFrame(rows, "k string, t long, id long").repartition(7)
    got = B.deal_blocks(df, ["k"], ["t", "id"], 20).withColumn("_task", F.spark_partition_id()).collect()
    assert sorted(((r.k, r.t, r.id) for r in got), key=str) == sorted(rows, key=str)
    place = lambda r: (r.t is not None, r.t or 0, r.id)
    for k in (None, "d", "e", "same"):
        own = sorted((r for r in got if r.k == k), key=place)
        assert [r._blk for r in own] == sorted(r._blk for r in own) and own[0]._blk == 0
        assert {r._split for r in own} == {len(own) > 20}
        sizes = [sum(r._blk == b for r in own) for b in {r._blk for r in own}]
        assert k == "same" and sizes == [90] or max(sizes) <= 20
    assert len({(r.k, r._blk) for r in got}) == len({(r.k, r._blk, r._task) for r in got})


def test_severity_by_a_table(spark):
    scored = spark.createDataFrame([("a", "m", 2.0), ("b", "m", 2.0), ("a", "n", 9.0), ("a", "m", None), (None, "m", 3.0), ("c", "m", 2.0)],
                                   "device_id string, metric string, z double")
    th = spark.createDataFrame([("m", None, 1.5, 3.0), ("m", "b", 2.5, None), ("m", "b", 2.1, 4.0), ("m", "c", None, 2.0), (None, "a", 0.0, 0.0),
                                ("other", None, 0.0, 0.0)], "metric string, device_id string, warning double, critical double")
    got = [(r.device_id, r.metric, r.z, r.severity) for r in D.severity_for(scored, th, metrics=["m", "n"]).collect()]
    assert sorted(got, key=str) == sorted([("a", "m", 2.0, "warning"), ("b", "m", 2.0, None), ("a", "n", 9.0, None), ("a", "m", None, None),
                                           (None, "m", 3.0, "critical"), ("c", "m", 2.0, "critical")], key=str)
    own = th.drop("device_id").where("metric = 'other'")
    assert {r.severity for r in D.severity_for(scored, own, metrics=["m", "n"]).collect()} == {None}


@pytest.mark.parametrize("window, target, parts", [(5, 7, 1), (40, 9, 1), (40, 100, 4), (700, 90, 1)])
def test_edges_of_a_key_are_dealt_over_parts(spark, monkeypatch, window, target, parts):
    """Nulls included, the same numbers as one window over the key; no task has all edge rows of a key."""
    monkeypatch.setattr(D, "PART_BLOCKS", parts)
    rows = [("d", i, None if i % 11 < 8 and i < 900 else i * 37 % 101 / 4) for i in range(2500)] + [("e", i, 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, i long, x double")
    out = D.rolling_stats(df, ["k"], ["i"], window=window, target_rows=target)
    values = {k: [x if x is None else round(x * 100) for q, _, x in rows if q == k] for k in "de"}
    got = out.collect()
    for r in got:
        frame = values[r.k][max(0, r.i - window + 1):r.i + 1]
        last = [v for v in frame if v is not None]
        want = (len(frame), sum(last) if last or window >= D.PREFIX_SUMS_FROM else None)
        assert (r.n, r.s) == want or (window >= D.PREFIX_SUMS_FROM and not last and not r.s), (r, want)
        assert not last or int(r.q) == sum(v * v for v in last)
    assert len(got) == len(rows)
    assert "_part" in out._jdf.queryExecution().analyzed().toString()
