"""Stream = batch, restarts, idempotent replays and rollup refresh."""
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fleetscope.operators.detect import detect_anomalies
from fleetscope.operators.rollup import rollup_5min
from fleetscope.plans.refresh import read_rollup, refresh_rollup
from fleetscope.session import new_subdir
from fleetscope.sources import fixtures as FX
from fleetscope.streaming.jobs import run_to_end, start_alerts_query, start_events_query
from fleetscope.streaming.sinks import read_alerts, write_events_by_month

KEY = ["device_id", "detected_at", "metric", "severity", "z_score", "rolling_mean"]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*KEY).collect())


def _batch_alerts(spark):
    return detect_anomalies(FX.load_telemetry(spark, SF_SMALL)).withColumn(
        "detected_at", F.col("detected_at").cast("timestamp"))


def test_stream_restart_between_files_equals_batch(spark):
    root = new_subdir(spark, "t-stream")
    view = FX.load_telemetry(spark, SF_SMALL)
    msgs = FX.wire_messages(view, replay_below=5)
    hi = msgs.agg(F.max("offset")).first()[0]
    first, rest = msgs.where(F.col("offset") <= hi // 2), msgs.where(F.col("offset") > hi // 2)
    src = {"path": f"{root}/messages", "options": {"maxFilesPerTrigger": str(FX.FILES)}}
    FX.write_wire_chunks(first, src["path"], chunks=2)
    run_to_end(start_alerts_query(spark, src, f"{root}/alerts", f"{root}/_ck"))
    part1 = read_alerts(spark, f"{root}/alerts").count()
    FX.write_wire_chunks(rest, src["path"], chunks=2)
    run_to_end(start_alerts_query(spark, src, f"{root}/alerts", f"{root}/_ck"))
    got = read_alerts(spark, f"{root}/alerts")
    assert 0 < part1 < got.count()
    assert _rows(got) == _rows(_batch_alerts(spark))
    # a third run with nothing new adds nothing
    run_to_end(start_alerts_query(spark, src, f"{root}/alerts", f"{root}/_ck"))
    assert read_alerts(spark, f"{root}/alerts").count() == 47


def test_replayed_batch_is_not_duplicated(spark):
    root = new_subdir(spark, "t-replay")
    view = FX.load_telemetry(spark, SF_SMALL).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    batch = view.where(F.col("event_id") < 300)
    write_events_by_month(batch, 7, f"{root}/events", extra=[])
    write_events_by_month(batch, 7, f"{root}/events", extra=[])
    write_events_by_month(view.where(F.col("event_id") >= 300), 8, f"{root}/events", extra=[])
    assert spark.read.parquet(f"{root}/events").count() == 1000


def test_incremental_refresh_equals_full_rollup(spark):
    root = new_subdir(spark, "t-refresh")
    view = FX.load_telemetry(spark, SF_SMALL).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    events = f"{root}/events"
    write_events_by_month(view.where(F.col("event_id") < 500), 0, events, extra=[])
    m1 = refresh_rollup(spark, events, f"{root}/rollup")
    assert m1["last_batch"] == {"batch": 0} and m1["version"] == 1
    assert refresh_rollup(spark, events, f"{root}/rollup") == m1  # nothing new
    write_events_by_month(view.where(F.col("event_id") >= 500), 1, events, extra=[])
    m2 = refresh_rollup(spark, events, f"{root}/rollup")
    assert m2["version"] == 2 and m2["last_batch"] == {"batch": 1}
    got = read_rollup(spark, f"{root}/rollup")
    want = rollup_5min(view)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_refresh_from_empty(spark):
    root = new_subdir(spark, "t-empty")
    assert read_rollup(spark, f"{root}/rollup").count() == 0


def test_events_stream_counts(spark):
    root = new_subdir(spark, "t-events")
    msgs = FX.wire_messages(FX.load_telemetry(spark, SF_SMALL), replay_below=10)
    FX.write_wire_chunks(msgs, f"{root}/messages", chunks=3)
    q = start_events_query(spark, {"path": f"{root}/messages", "options": {"maxFilesPerTrigger": str(FX.FILES)}},
                           f"{root}/events", f"{root}/_ck")
    run_to_end(q)
    ev = spark.read.parquet(f"{root}/events")
    assert ev.count() == 1000
    assert ev.select("event_month").distinct().count() == 1
    assert ev.select("batch_id").distinct().count() == 3


def test_one_file_per_month_of_a_batch(spark):
    root = new_subdir(spark, "t-files")
    view = FX.load_telemetry(spark, SF_SMALL).repartition(8)
    write_events_by_month(view, 0, f"{root}/events", extra=[])
    months = view.select(F.date_format("event_timestamp", "yyyy-MM")).distinct().count()
    assert len(spark.read.parquet(f"{root}/events").inputFiles()) == months


def test_another_run_does_not_replace_batches(spark):
    """A new checkpoint starts at batch 0 again; what the old run stored stays."""
    root = new_subdir(spark, "t-runs")
    msgs = FX.wire_messages(FX.load_telemetry(spark, SF_SMALL))
    for k, part in enumerate((msgs.where("offset < 500"), msgs.where("offset >= 500"))):
        FX.write_wire_chunks(part, f"{root}/messages{k}", chunks=1)
        run_to_end(start_events_query(spark, {"path": f"{root}/messages{k}"}, f"{root}/events", f"{root}/_ck{k}"))
    events = spark.read.parquet(f"{root}/events")
    assert events.count() == 1000 and events.select("run_id").distinct().count() == 2


def test_half_written_batch_and_crash_between_manifest_steps(spark, monkeypatch):
    from fleetscope.plans import refresh as RF
    root = new_subdir(spark, "t-crash")
    msgs = FX.wire_messages(FX.load_telemetry(spark, SF_SMALL))
    src = {"path": f"{root}/messages"}
    FX.write_wire_chunks(msgs.where("offset < 600"), src["path"], chunks=1)
    run_to_end(start_events_query(spark, src, f"{root}/events", f"{root}/_ck"))
    RF.refresh_rollup(spark, f"{root}/events", f"{root}/rollup", checkpoint=f"{root}/_ck")
    before = sorted(map(tuple, read_rollup(spark, f"{root}/rollup").collect()))

    # a batch of the same run that is written but not in the commit log
    run = RF.run_id_of(spark, f"{root}/_ck")
    rest = FX.load_telemetry(spark, SF_SMALL).where("event_id >= 600").withColumn(
        "event_timestamp", F.col("event_timestamp").cast("timestamp"))
    write_events_by_month(rest, 1, f"{root}/events", extra=[], run_id=run)
    assert RF.refresh_rollup(spark, f"{root}/events", f"{root}/rollup", checkpoint=f"{root}/_ck")["version"] == 1

    # the refresh dies after the data and the temporary manifest are written
    real, calls = RF._fs, []

    def dies(sp, path):
        fs, p, jvm = real(sp, path)
        if "_manifest-2" in path:
            calls.append(path)

            class Broken:
                def __getattr__(self, name):
                    if name == "rename":
                        raise OSError("crash")
                    return getattr(fs, name)
            return Broken(), p, jvm
        return fs, p, jvm

    monkeypatch.setattr(RF, "_fs", dies)
    with pytest.raises(OSError):
        RF.refresh_rollup(spark, f"{root}/events", f"{root}/rollup")
    monkeypatch.setattr(RF, "_fs", real)
    assert calls and sorted(map(tuple, read_rollup(spark, f"{root}/rollup").collect())) == before
    assert RF.refresh_rollup(spark, f"{root}/events", f"{root}/rollup")["version"] == 2
    assert read_rollup(spark, f"{root}/rollup").agg(F.sum("event_count")).first()[0] == 1000


def test_progress_of_more_batches_than_spark_reports(spark):
    """Totals over 105 micro-batches and a restart; Spark itself keeps 100 reports."""
    from fleetscope.streaming.sinks import ProgressLog, read_progress
    root = new_subdir(spark, "t-progress")
    spark.range(210).withColumn("_file", F.expr("id div 2")).repartition(8, "_file").write.partitionBy("_file").parquet(f"{root}/in")
    log = ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(log)
    try:
        ids = set()
        for part in ("_file=[0-9]*", ):
            for _ in range(2):
                rows = (spark.readStream.schema("id long").option("maxFilesPerTrigger", "2").parquet(f"{root}/in/{part}")
                        .observe("batch", F.count(F.lit(1)).alias("events")))
                q = (rows.writeStream.foreachBatch(lambda df, i: df.write.format("noop").mode("overwrite").save())
                     .option("checkpointLocation", f"{root}/_ck").trigger(availableNow=True).start())
                run_to_end(q)
                ids.add(q.id)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        import time
        time.sleep(2)
    finally:
        spark.streams.removeListener(log)
    assert len(ids) == 1
    got = read_progress(spark, f"{root}/progress", ids.pop(), ["input_rows", "events"]).orderBy("batch_id").collect()
    assert got[-1].total_input_rows == got[-1].total_events == 210
    assert len(got) > 50 and sum(r.events for r in got) == 210


def test_detector_devices_not_dedup_keys_are_tracked(spark):
    from fleetscope.streaming.sinks import ProgressLog, read_progress
    import time
    root = new_subdir(spark, "t-tracked")
    FX.write_wire_chunks(FX.wire_messages(FX.load_telemetry(spark, SF_SMALL)), f"{root}/messages", chunks=1)
    log = ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(log)
    try:
        q = start_alerts_query(spark, {"path": f"{root}/messages"}, f"{root}/alerts", f"{root}/_ck",
                               publish={"path": f"{root}/published"})
        run_to_end(q)
        time.sleep(2)
    finally:
        spark.streams.removeListener(log)
    rows = read_progress(spark, f"{root}/progress", q.id, ["anomalies", "critical"]).collect()
    assert max(r.devices_tracked for r in rows) == 15
    assert max(r.total_anomalies for r in rows) == 47
    assert spark.read.json(f"{root}/published").count() == 47


def test_stream_equals_batch_with_nulls_flat_runs_small_window(spark):
    """Readings with nulls and flat runs, window 5, over three micro-batches;
    exact and general (double) forms against the batch operator."""
    import random

    from pyspark.sql import types as T

    from fleetscope.operators.detect import detect_anomalies
    from fleetscope.streaming.detect_stream import detect_anomalies_stream
    rng = random.Random(3)
    rows = []
    for i in range(240):
        dev = f"d{i % 3}"
        if i % 17 == 0:
            x = None
        elif 60 <= i < 120:
            x = 5.0  # flat run: std 0, no alerts
        else:
            x = round(rng.uniform(0, 10), 2) if i % 23 else 90.0
        rows.append((dev, i, x))
    schema = T.StructType([T.StructField("device_id", T.StringType()), T.StructField("event_id", T.LongType()),
                           T.StructField("cpu_usage_pct", T.DoubleType())])
    df = spark.createDataFrame(rows, schema).withColumn("ts", F.col("event_id"))
    th = {"cpu_usage_pct": (1.5, 2.0)}
    root = new_subdir(spark, "t-small")
    for k in range(3):
        df.where((F.col("event_id") >= 80 * k) & (F.col("event_id") < 80 * (k + 1))).coalesce(1) \
          .write.mode("append").parquet(f"{root}/in")
    for exact in (True, False):
        src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/in")
        out = detect_anomalies_stream(src, time_col="ts", order_cols=["event_id"], metrics=["cpu_usage_pct"],
                                      thresholds=th, window=5, exact=exact)
        name = f"small_{int(exact)}"
        q = (out.writeStream.format("memory").queryName(name).outputMode("append")
             .option("checkpointLocation", f"{root}/_ck{int(exact)}").trigger(availableNow=True).start())
        q.awaitTermination()
        got_rows = spark.table(name).collect()
        want_rows = detect_anomalies(df, time_col="ts", order_cols=["event_id"], metrics=["cpu_usage_pct"],
                                     thresholds=th, window=5, exact=exact).collect()
        got = {(r.device_id, r.detected_at, r.severity) for r in got_rows}
        want = {(r.device_id, r.detected_at, r.severity) for r in want_rows}
        assert len(want) > 0
        # integers: identical decisions; doubles: unless z equals a threshold as a number
        z = {(r.device_id, r.detected_at): r.z_score for r in got_rows + want_rows}
        for dev, t, _ in got ^ want:
            assert not exact and z[(dev, t)] in (1.5, 2.0), (dev, t, z[(dev, t)])


def test_a_huge_value_leaves_no_trace(spark):
    """300 readings around 50 after one of 1e10: std as small as before."""
    import numpy as np

    from fleetscope.streaming.detect_stream import _half_up, _score_metric
    x = np.concatenate([[1e10], 50 + 0.01 * np.sin(np.arange(300))])
    _, n, _, mean, _, std = _score_metric(np.zeros(0), x, 60, 100, False)
    for i in (100, 299):
        last = x[i - 59:i + 1]
        assert n[i] == 60 and abs(mean[i] - last.mean()) < 1e-9 and abs(std[i] - last.std()) < 1e-9
    assert _half_up(np.array([12.5, 13.5, -12.5])).tolist() == [13, 14, -13]


def test_late_readings_are_kept(spark):
    """A micro-batch of readings days older than the ones already seen is
    stored and scored, not dropped (dedup watermark is on arrival time)."""
    root = new_subdir(spark, "t-late")
    msgs = FX.wire_messages(FX.load_telemetry(spark, SF_SMALL))
    hi = msgs.agg(F.max("offset")).first()[0]
    FX.write_wire_chunks(msgs.where(F.col("offset") > hi // 2), f"{root}/messages", chunks=1)
    FX.write_wire_chunks(msgs.where(F.col("offset") <= hi // 2), f"{root}/messages", chunks=1)
    q = start_events_query(spark, {"path": f"{root}/messages", "options": {"maxFilesPerTrigger": str(FX.FILES)}},
                           f"{root}/events", f"{root}/_ck")
    run_to_end(q)
    assert spark.read.parquet(f"{root}/events").count() == 1000


def test_vacuum_keeps_live_months(spark):
    from fleetscope.plans.refresh import vacuum_rollup
    root = new_subdir(spark, "t-vacuum")
    view = FX.load_telemetry(spark, SF_SMALL).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    events = f"{root}/events"
    for b, (lo, hi) in enumerate([(0, 300), (300, 600), (600, 1000)]):
        write_events_by_month(view.where((F.col("event_id") >= lo) & (F.col("event_id") < hi)), b, events, extra=[])
        refresh_rollup(spark, events, f"{root}/rollup")
    before = read_rollup(spark, f"{root}/rollup").count()
    deleted = vacuum_rollup(spark, f"{root}/rollup", retain=1)
    assert all("_v=1/" in d for d in deleted)  # _v=2 kept for readers, _v=3 live
    assert read_rollup(spark, f"{root}/rollup").count() == before == rollup_5min(view).count()


def test_files_of_a_chunk_grow_in_number_and_none_is_missing(spark, monkeypatch):
    """Large chunks have more files, each written by one task; a range of offsets without messages takes no file of the next chunk."""
    import glob
    monkeypatch.setattr(FX, "FILE_ROWS", 50)
    files = FX.chunk_files(1000, 3)
    assert files == 7 and FX.chunk_files(10, 3) == FX.FILES
    root = new_subdir(spark, "t-chunks")
    view = FX.load_telemetry(spark, SF_SMALL)
    msgs = FX.wire_messages(view.where("event_id < 100 or event_id >= 200"))
    FX.write_wire_chunks(msgs, f"{root}/messages", chunks=3, files=files)
    assert len(glob.glob(f"{root}/messages/_file=*/*.json*")) == 21 and not glob.glob(f"{root}/*staging*")
    q = start_events_query(spark, {"path": f"{root}/messages", "options": {"maxFilesPerTrigger": str(files)}}, f"{root}/events", f"{root}/_ck")
    run_to_end(q)
    ev = spark.read.parquet(f"{root}/events")
    last = ev.groupBy("batch_id").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).orderBy("batch_id").collect()
    assert ev.count() == 900 and [(r["lo"], r["hi"]) for r in last] == [(0, 333), (334, 666), (667, 999)]


def test_a_device_call_takes_few_columns_and_keeps_numbers_and_nulls(spark):
    """Each column of a call costs it as much as scoring; numbers with nulls among them are not taken for doubles."""
    from fleetscope.streaming.detect_stream import detect_anomalies_stream
    root = new_subdir(spark, "t-packed")
    rows = spark.range(200).selectExpr(
        "concat('d', id % 2) AS device_id", "id AS nr", "CASE WHEN id % 20 < 10 THEN id + (1L << 60) END AS big",
        "CASE WHEN id % 40 >= 20 THEN timestamp_micros(id * 1000001) END AS at", "concat('k', id) AS name",
        "CASE WHEN id % 20 < 15 THEN timestamp_ntz'2024-01-01 00:00:00.000001' + make_dt_interval(id) END AS local", "date_from_unix_date(cast(id AS int)) AS day",
        "CASE WHEN id >= 100 AND id % 10 < 2 THEN 500.25 ELSE id % 7 END AS a", "CASE WHEN id % 3 > 0 THEN id % 5 END AS b")
    rows.coalesce(1).write.parquet(f"{root}/in")
    src = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
    out = detect_anomalies_stream(src, time_col="day", order_cols=["at", "nr"], metrics=["a", "b"], window=20,
                                  thresholds={"a": (1.5, 2.0), "b": (1.5, 2.0)}, keep=["big", "name", "local"])
    q = (out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/_ck")
         .trigger(availableNow=True).start())
    run_to_end(q)
    plan = q._jsq.explainInternal(False) if hasattr(q._jsq, "explainInternal") else q._jsq.toString()
    node = next(line for line in plan.splitlines() if "FlatMapGroupsInPandasWithState" in line)
    assert "_i#" in node and "big#" not in node and "day#" not in node
    got = spark.read.parquet(f"{root}/out")
    assert got.schema["big"].dataType == rows.schema["big"].dataType and got.schema["detected_at"].dataType == rows.schema["day"].dataType
    want = rows.selectExpr("name", "big", "local", "day AS detected_at", "device_id")
    found = got.select("name", "big", "local", "detected_at", "device_id")
    n = found.count()
    assert n > 10 and found.where("big IS NULL").count() > 0 and found.where("big IS NOT NULL").count() > 0
    assert found.distinct().intersect(want).count() == found.distinct().count()
    from fleetscope.operators.detect import detect_anomalies
    batch = detect_anomalies(rows.withColumn("at", F.coalesce("at", F.lit("9999-01-01").cast("timestamp"))), time_col="day",
                             order_cols=["at", "nr"], metrics=["a", "b"], window=20,
                             thresholds={"a": (1.5, 2.0), "b": (1.5, 2.0)}, keep=["name"])
    key = ["name", "metric", "severity", "z_score", "rolling_mean", "rolling_std_dev", "observed_value"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, batch.select(*key).collect()))


def test_validation_is_compiled(spark):
    """No generated method of the valid rows' plan is longer than the 8,000 bytes that the JVM compiles."""
    from fleetscope.operators.ingest import conform_event, quarantine_invalid, split_valid
    from fleetscope.sources.messages import decode_telemetry
    valid, _ = split_valid(quarantine_invalid(decode_telemetry(FX.wire_messages(FX.load_telemetry(spark, SF_SMALL), faults=True))))
    rows = conform_event(valid, keep=["partition", "offset"])
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    stages = getattr(debug, "MODULE$").codegenStringSeq(rows._jdf.queryExecution().executedPlan())
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert sizes and max(sizes) < 8000
