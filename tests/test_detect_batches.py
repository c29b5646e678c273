"""Detection by micro-batch with tails: equal to the batch operator, also for a hot device, replays and nulls."""
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fleetscope.operators.detect import MONITORED_METRICS, detect_anomalies
from fleetscope.session import new_subdir
from fleetscope.sources import fixtures as FX
from fleetscope.streaming.detect_batches import TailTable, detect_batch
from fleetscope.streaming.jobs import run_to_end, start_split_alerts_query
from fleetscope.streaming.sinks import read_alerts

KEY = ["device_id", "detected_at", "metric", "severity", "observed_value", "z_score", "rolling_mean", "rolling_std_dev"]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*KEY).collect())


def _hot_view(spark):
    """One device has a third of all readings; some readings are null."""
    view = FX.partial_view(FX.load_telemetry(spark, SF_SMALL))
    return view.withColumn("device_id", F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("device_id")))


@pytest.mark.parametrize("target_rows,window,full_every", [(40, 60, 2), (1_000_000, 60, 32), (25, 5, 1), (40, 1, 2)])
def test_batches_equal_the_batch_operator(spark, target_rows, window, full_every):
    view = _hot_view(spark).cache()
    tails = TailTable(spark, f"{new_subdir(spark, 't-tails')}/tails", full_every=full_every)
    edges, got = [0, 300, 301, 302, 620, 900, 10 ** 9], []
    for b, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        part = view.where((F.col("event_id") >= lo) & (F.col("event_id") < hi))
        tails.drop_unused(b)
        seen = []
        for _ in range(2 if b in (1, 3) else 1):  # some batches are replayed
            found, tail = detect_batch(part, tails.read(b), b, order_cols=["event_id"], window=window, target_rows=target_rows)
            seen.append(_rows(found))
            tails.write(tail, b)
        assert all(s == seen[0] for s in seen)
        got += seen[0]
    want = detect_anomalies(view, order_cols=["event_id"], window=window)
    assert sorted(got) == _rows(want)
    assert window == 1 or got
    kept = tails.read(len(edges))
    most = kept.groupBy("device_id", "metric", "_version").count().agg(F.max("count")).first()[0]
    assert (most or 0) <= window - 1
    assert len(tails.versions(len(edges))) <= full_every
    view.unpersist()


def test_empty_batch_and_rows_without_a_device(spark):
    view = _hot_view(spark)
    tails = TailTable(spark, f"{new_subdir(spark, 't-tails')}/tails")
    first = view.where("event_id < 300")
    _, tail = detect_batch(first, None, 0, order_cols=["event_id"])
    tails.write(tail, 0)
    nobody = view.limit(5).withColumn("device_id", F.lit(None).cast("string"))
    for b, part in ((1, view.where("event_id < 0")), (2, nobody)):
        found, tail = detect_batch(part, tails.read(b), b, order_cols=["event_id"])
        assert found.count() == 0
        tails.write(tail, b)
    found, _ = detect_batch(view.where("event_id >= 300"), tails.read(3), 3, order_cols=["event_id"])
    want = detect_anomalies(view, order_cols=["event_id"], keep=["event_id"]).where("event_id >= 300")
    assert _rows(found) == _rows(want)


def test_hot_device_in_a_stream(spark):
    """Messages are delivered again and the query is restarted: each alert is there once, as in the batch operator."""
    root = new_subdir(spark, "t-split")
    view = _hot_view(spark)
    msgs = FX.wire_messages(view, replay_below=5)
    half = msgs.agg(F.max("offset")).first()[0] // 2
    src = {"path": f"{root}/messages", "options": {"maxFilesPerTrigger": str(FX.FILES)}}
    for part in (msgs.where(F.col("offset") <= half), msgs.where((F.col("offset") > half) | (F.col("offset") % 9 == 0))):
        FX.write_wire_chunks(part, src["path"], chunks=2)
        run_to_end(start_split_alerts_query(spark, src, f"{root}/alerts", f"{root}/_ck", target_rows=60))
    want = detect_anomalies(view, order_cols=["event_id"]).withColumn("detected_at", F.col("detected_at").cast("timestamp"))
    assert _rows(read_alerts(spark, f"{root}/alerts")) == _rows(want)
    assert want.where("device_id = 'hot'").count() and set(MONITORED_METRICS)
