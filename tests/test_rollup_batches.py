"""The rollup by micro-batch: late readings counted and folded in, replays harmless."""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetscope.operators.rollup import rollup_5min
from fleetscope.session import new_subdir
from fleetscope.streaming.rollup_batches import Clock, late_windows, read_rollup_batches, write_rollup_batch

T0 = datetime(2025, 3, 1, 10, 0)
SCHEMA = ("device_id string, model string, firmware string, network_type string, event_timestamp timestamp, "
          "cpu_usage_pct double, memory_usage_pct double, signal_strength_dbm double, throughput_mbps double, "
          "battery_pct double, event_type string")


def _rows(minutes):
    return [(f"D{i % 3}", "m", "f", "wifi", T0 + timedelta(minutes=m), 10.25 + i, 50.0, -70.0, 100.0 + m, 80.0,
             "critical" if i % 4 == 0 else "normal") for i, m in enumerate(minutes)]


def test_late_readings_correct_their_windows(spark):
    root = new_subdir(spark, "late-rollup")
    # by minute; batch 1 begins with the watermark at 30 - 10, batch 2 at 60 - 10, and batch 3 is empty
    minutes = [[0, 1, 2, 14, 30], [3, 14.9, 15, 19.9, 20, 29, 60], [0, 44, 44.9, 45, 49.9, 50, 59, 61], []]
    ends = lambda m: (int(m) // 5 + 1) * 5
    marks = [None, 30 - 10, 60 - 10, 61 - 10]
    want_late = [sum(w is not None and ends(m) <= w for m in ms) for ms, w in zip(minutes, marks)]
    assert want_late == [0, 4, 5, 0]
    batches = [spark.createDataFrame(_rows(m), SCHEMA) for m in minutes]
    clock, aside = Clock(spark, f"{root}/clock"), []
    totals = []
    for i, b in enumerate(batches):
        for _ in range(2 if i == 1 else 1):  # batch 1 is run again
            after = write_rollup_batch(b, i, f"{root}/rollup", clock, write_late=lambda rows, n: aside.append((n, rows.count())))
        totals.append((after["readings"], after["late_readings"]))
    assert totals == [(5, 0), (12, 4), (20, 9), (20, 9)]
    assert aside == [(1, 4), (1, 4), (2, 5)]
    every = batches[0].unionByName(batches[1]).unionByName(batches[2])
    got, want = read_rollup_batches(spark, f"{root}/rollup"), rollup_5min(every)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    assert late_windows(spark, f"{root}/rollup").agg(F.sum("late_readings")).first()[0] == 9


def test_missing_clock_is_an_error(spark):
    root = new_subdir(spark, "late-rollup")
    clock = Clock(spark, f"{root}/clock")
    clock.write({"batch_id": 0, "max_time": None, "readings": 0, "late_readings": 0})
    assert clock.after(0)["max_time"] is None
    with pytest.raises(ValueError):
        clock.after(2)
    with pytest.raises(ValueError):
        write_rollup_batch(spark.createDataFrame([], SCHEMA), 0, f"{root}/rollup", clock, delay_minutes=-1)
