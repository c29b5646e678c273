"""Boundary rows (classification, checks, limits) and bad messages."""
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from fleetscope.functions import expressions as X
from fleetscope.operators import reports as R
from fleetscope.operators.ingest import conform_event, quarantine_invalid, split_valid
from fleetscope.sources.messages import decode_telemetry

GOOD = {"device_id": "DEV-00001", "model": "tracker-c", "firmware": "r3", "network_type": "mesh",
        "timestamp": "2025-03-01T10:00:00.123456+00:00", "cpu_usage_pct": 40.0,
        "memory_usage_pct": 50.0, "signal_strength_dbm": -70.0, "throughput_mbps": 200.0,
        "battery_pct": 80.0, "event_type": "normal"}


def _classify(spark, cpu=40.0, signal=-70.0, thr=200.0):
    df = spark.createDataFrame([(float(cpu), float(signal), float(thr))], "cpu_usage_pct double, signal_strength_dbm double, throughput_mbps double")
    return X.classify_event_type(df).first().event_type


@pytest.mark.parametrize("kw,want", [
    (dict(cpu=70), "normal"), (dict(cpu=70.01), "degraded"), (dict(cpu=85), "degraded"), (dict(cpu=85.01), "critical"),
    (dict(signal=-90), "normal"), (dict(signal=-90.01), "degraded"), (dict(signal=-105), "degraded"),
    (dict(signal=-105.01), "critical"),
    (dict(thr=50), "normal"), (dict(thr=49.99), "degraded"), (dict(thr=10), "degraded"), (dict(thr=9.99), "critical"),
])
def test_classification_boundaries(spark, kw, want):
    assert _classify(spark, **kw) == want


def _messages(spark, texts):
    rows = [(b"k", t if isinstance(t, bytes) else t.encode("utf-8"), "device-telemetry", 0, i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long")


def _reasons(spark, texts):
    q = quarantine_invalid(decode_telemetry(_messages(spark, texts)))
    return [r.reasons for r in q.select("offset", F.concat_ws(",", "reject_reasons").alias("reasons"))
            .orderBy("offset").collect()]


def _with(**kw):
    d = dict(GOOD)
    d.update(kw)
    return json.dumps(d)


def test_bad_messages(spark):
    nan = json.dumps(GOOD).replace('"cpu_usage_pct": 40.0', '"cpu_usage_pct": NaN')
    x = json.dumps(GOOD).replace('"cpu_usage_pct": 40.0', '"cpu_usage_pct": "x"')
    got = _reasons(spark, [json.dumps(GOOD), "{}", "{bad", "[1]", nan, x, b'{"device_id": "\xff"}'])
    assert got[0] == ""
    assert got[1].startswith("missing:device_id") and "missing:event_type" in got[1]
    assert got[2] == "malformed" and got[3] == "malformed"
    assert got[4] == "not_finite:cpu_usage_pct"
    assert got[5] == "malformed"
    assert got[6] == "malformed"


def test_one_object_only(spark):
    good, other = json.dumps(GOOD), json.dumps(dict(GOOD, device_id="other"))
    digest = hashlib.sha256(good.encode()).hexdigest()
    closing = [good + end for end in ("]", "}", "]}", "],", ",", ",0", "," + other, "]}junk", " junk", other)]
    forged = [good + '],"m":[' + other, good + '],"x":[' + other, good + ',{"_mark":"%s"}]}' % digest,
              good + ',{"_mark":"%s"}],"m":[{"_mark":"%s"},%s' % (digest, digest, other)]
    early = ['],"m":[' + good, "0," + good, "[" + good + "]", "", " ", "null", "1", '"a"']
    assert _reasons(spark, closing + forged + early) == ["malformed"] * len(closing + forged + early)
    extra = json.dumps(dict(GOOD, _mark="x", m=[1, {"_mark": 2}], unknown={"a": [1]}))
    twice = good[:-1] + ', "device_id": "second"}'
    assert _reasons(spark, [good, " \t\r\n" + good + "\n", twice, extra.replace('"_mark": "x", ', "")]) == [""] * 4
    rows = decode_telemetry(_messages(spark, [twice, good + " junk"])).orderBy("offset").collect()
    assert rows[0].device_id == "second" and rows[0]._corrupt is None and not rows[0]._not_object
    assert rows[1]._corrupt == good + " junk" and rows[1].device_id is None


def test_messages_are_parsed_once(spark):
    plan = decode_telemetry(_messages(spark, [json.dumps(GOOD)]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "json_array_length" not in plan


@pytest.mark.parametrize("field,ok,bad", [
    ("cpu_usage_pct", [0, 100], [-0.01, 100.01]),
    ("memory_usage_pct", [0, 100], [-0.01, 100.01]),
    ("battery_pct", [0, 100], [-0.01, 100.01]),
    ("signal_strength_dbm", [-120, -40], [-120.01, -39.99]),
    ("throughput_mbps", [0], [-0.01]),
])
def test_range_checks(spark, field, ok, bad):
    got = _reasons(spark, [_with(**{field: float(v)}) for v in ok + bad])
    assert got[:len(ok)] == [""] * len(ok)
    assert got[len(ok):] == [f"out_of_range:{field}"] * len(bad)


def test_enum_and_lengths(spark):
    got = _reasons(spark, [_with(event_type=t) for t in ("normal", "degraded", "critical", "other")]
                   + [_with(device_id="D" * 21), _with(network_type="WIFI6E"), _with(timestamp="yesterday")])
    assert got == ["", "", "", "bad_value:event_type", "too_long:device_id", "too_long:network_type",
                   "bad_value:timestamp"]


def test_conform_types_and_rounding(spark):
    q = quarantine_invalid(decode_telemetry(_messages(spark, [_with(cpu_usage_pct=12.345, battery_pct=99.994)])))
    valid, rejected = split_valid(q)
    assert rejected.count() == 0
    row = conform_event(valid).first()
    assert str(row.cpu_usage_pct) == "12.35" and str(row.battery_pct) == "99.99"
    assert row.event_timestamp.microsecond == 123456


def test_time_parsing(spark):
    df = spark.createDataFrame([("2025-03-01T10:00:00+00:00",), ("2025-03-01T10:00:00.5Z",),
                                ("2025-03-01T12:00:00.000001+02:00",), ("nope",)], "t string")
    got = [r.p for r in df.select(X.parse_event_time("t").cast("string").alias("p")).collect()]
    assert got == ["2025-03-01 10:00:00", "2025-03-01 10:00:00.5", "2025-03-01 10:00:00.000001", None]


def test_clamp(spark):
    df = spark.createDataFrame([(120.0, -0.5, -130.0, -3.0, 12.345)],
                               "cpu_usage_pct double, memory_usage_pct double, signal_strength_dbm double, "
                               "throughput_mbps double, battery_pct double")
    r = X.clamp_metrics(df).first()
    assert (r.cpu_usage_pct, r.memory_usage_pct, r.signal_strength_dbm, r.throughput_mbps, r.battery_pct) == \
        (100.0, 0.0, -120.0, 0.0, 12.35)


@pytest.mark.parametrize("fn,kw", [
    (R.device_summary, dict(limit=0)), (R.device_summary, dict(limit=1001)),
    (R.device_metrics, dict(device_id="a", limit=5001)), (R.device_metrics, dict(device_id="a", since_minutes=0)),
    (R.device_metrics, dict(device_id="a", since_minutes=1441)),
    (R.device_anomalies, dict(device_id="a", limit=501)), (R.device_anomalies, dict(device_id="a", severity="info")),
    (R.recent_anomalies, dict(limit=1001)), (R.recent_anomalies, dict(severity="bad")),
])
def test_parameter_ranges(spark, fn, kw):
    df = spark.createDataFrame([], "device_id string, model string, firmware string, network_type string")
    with pytest.raises(ValueError):
        fn(df, **kw)


def test_limits_accept_bounds(spark):
    from conftest import SF_SMALL
    from fleetscope.sources.fixtures import load_telemetry
    t = load_telemetry(spark, SF_SMALL)
    assert R.device_summary(t, limit=1).count() == 1
    assert R.device_summary(t, limit=1000).count() == 15


def test_not_found(spark):
    from conftest import SF_SMALL
    from fleetscope.sources.fixtures import load_telemetry
    t = load_telemetry(spark, SF_SMALL)
    with pytest.raises(R.NotFound):
        R.require_rows(R.device_metrics(t, "DEV-99999", as_of="2024-01-31 00:00:00"), "DEV-99999")


def test_empty_tables_give_zero_totals(spark):
    ev = spark.createDataFrame([], "device_id string, event_timestamp timestamp_ntz")
    al = spark.createDataFrame([], "severity string, detected_at timestamp_ntz")
    r = R.stats_summary(ev, al, as_of="2024-01-31 00:00:00").first()
    assert all(v == 0 for v in r.asDict().values())


def test_trailing_data_after_object_is_malformed(spark):
    got = _reasons(spark, [json.dumps(GOOD) + " x", json.dumps(GOOD) + "  \n", json.dumps(GOOD) + "�"])
    assert got == ["malformed", "", "malformed"]


def test_one_object_per_message(spark):
    one = json.dumps(GOOD)
    texts = [one, one + one, one + "}", one + "," + one, one + "],[{}", one + ",0],[{}", " " + one + "\n", one + " x"]
    assert [r == "" for r in _reasons(spark, texts)] == [True] + [False] * 5 + [True, False]


def test_checks_follow_the_stored_value(spark):
    """Rounded to the table's type first; what the type cannot hold is rejected."""
    cases = [({"cpu_usage_pct": 100.004}, ""), ({"cpu_usage_pct": 100.006}, "out_of_range:cpu_usage_pct"),
             ({"signal_strength_dbm": -39.996}, ""), ({"throughput_mbps": -0.004}, ""),
             ({"throughput_mbps": 999999.994}, ""), ({"throughput_mbps": 999999.995}, "out_of_range:throughput_mbps"),
             ({"throughput_mbps": 1e300}, "out_of_range:throughput_mbps")]
    texts = [json.dumps({**GOOD, **c}) for c, _ in cases]
    assert _reasons(spark, texts) == [r for _, r in cases]
    valid, _ = split_valid(quarantine_invalid(decode_telemetry(_messages(spark, texts))))
    rows = conform_event(valid).collect()
    assert [float(rows[0].cpu_usage_pct), float(rows[1].signal_strength_dbm), float(rows[2].throughput_mbps)] == [100, -40, 0]


def test_clamp_keeps_nan_and_rounds_once(spark):
    df = spark.createDataFrame([(float("nan"), 0.0049999999), (120.0, -5.0)], "cpu_usage_pct double, throughput_mbps double")
    got = X.clamp_metrics(df, {"cpu_usage_pct": (0.0, 100.0), "throughput_mbps": (0.0, None)}).collect()
    assert got[0].cpu_usage_pct != got[0].cpu_usage_pct and got[0].throughput_mbps == 0.0
    assert (got[1].cpu_usage_pct, got[1].throughput_mbps) == (100.0, 0.0)


def test_percentiles_skip_nulls_and_keep_their_names(spark):
    df = spark.createDataFrame([(None,)] * 5 + [(float(i),) for i in range(1, 6)], "lag_ms double")
    r = R.ingest_lag_percentiles(df, [], percentiles=(0.99, 0.994, 0.999)).first()
    assert r.asDict() == {"n": 5, "p50": 3.0, "p99": 5.0, "p99_4": 5.0, "p99_9": 5.0}
    assert R.ingest_lag_percentiles(df.where("lag_ms is null"), []).count() == 0


def test_shared_folder_is_not_made_up_on_a_cluster():
    from fleetscope.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return "yarn" if key == "spark.master" else default

    class Session:
        conf = Conf()
        sparkContext = None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())
