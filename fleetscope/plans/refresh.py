"""Refreshing the stored rollup without blocking readers (operator 28).

The rollup lives in version folders, ``<root>/_v=<n>/event_day=<d>``, of
additive rows (counts, sums of hundredths, max, min). Small numbered
manifests ``<root>/_manifest-<n>.json``, each written once and never
replaced, name the live folder of every day and the last event batch of
every run that is folded in; the highest number counts. A refresh:

1. reads only the event batches newer than the manifest's last batch of
   their run (partition pruning on ``run_id`` and ``batch_id``) and, where
   the stream's checkpoint is given, only those in its commit log,
2. merges those rows with the live rows of the days they touch and writes
   the merged days into a new version folder,
3. adds the next manifest: written under another name, then renamed to a
   name that does not exist yet. A crash before that leaves the old version.

Readers resolve the manifest first and read only the folders it names, so
a refresh never deletes or rewrites a folder that a running reader uses.
It works from an empty rollup (no manifest yet).
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.operators.rollup import finish_rollup, merge_partial_rollups, partial_rollup
from fleetscope.streaming.sinks import run_id_of

_MANIFEST = re.compile(r"_manifest-(\d+)\.json$")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _names(fs, p) -> list[str]:
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def _read_manifest(spark: SparkSession, root: str) -> dict:
    root = root.rstrip("/")
    fs, p, jvm = _fs(spark, root)
    versions = [int(m[1]) for m in map(_MANIFEST.match, _names(fs, p)) if m]
    if not versions:
        return {"days": {}, "last_batch": {}, "version": 0}
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{root}/_manifest-{max(versions)}.json"))
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        text = "".join(iter(reader.readLine, None))
    finally:
        stream.close()
    return json.loads(text)


def _write_manifest(spark: SparkSession, root: str, manifest: dict) -> None:
    root = root.rstrip("/")
    fs, final, jvm = _fs(spark, f"{root}/_manifest-{manifest['version']}.json")
    tmp = jvm.org.apache.hadoop.fs.Path(f"{root}/_tmp-{manifest['version']}.json")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode("utf-8")))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(tmp, final):
        raise RuntimeError(f"another refresh has written version {manifest['version']}")


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last micro-batch in a stream's commit log, -1 if there is none."""
    fs, p, _ = _fs(spark, f"{checkpoint.rstrip('/')}/commits")
    return max((int(n) for n in _names(fs, p) if n.isdigit()), default=-1)


def refresh_rollup(spark: SparkSession, events_path: str, root: str, checkpoint: str | None = None) -> dict:
    """Fold event batches newer than the last refresh into the rollup.
    Returns the new manifest.

    ``checkpoint`` names the checkpoint of the stream that writes the
    events: of its run only committed batches are folded, so that a batch
    that is half written is left for the next refresh. A folder left by a
    failed attempt is simply overwritten: no manifest names it.
    """
    manifest = _read_manifest(spark, root)
    fresh = spark.read.parquet(events_path)
    done = F.lit(False)
    for run, last in manifest["last_batch"].items():
        done = done | ((F.col("run_id") == run) & (F.col("batch_id") <= last))
    fresh = fresh.where(~done)
    if checkpoint:
        own = F.col("run_id") == run_id_of(spark, checkpoint)
        fresh = fresh.where(~own | (F.col("batch_id") <= committed_batch(spark, checkpoint)))
    # partition values only: a row for each run, and one for each touched day
    runs = {r.run_id: int(r.b) for r in fresh.groupBy("run_id").agg(F.max("batch_id").alias("b")).collect()}
    if not runs:
        return manifest
    parts = partial_rollup(fresh).withColumn("event_day", _day())
    days = sorted(r[0] for r in fresh.select(F.date_format("event_timestamp", "yyyy-MM-dd")).distinct().collect())
    version = manifest["version"] + 1
    old_paths = [manifest["days"][d] for d in days if d in manifest["days"]]
    if old_paths:
        parts = parts.unionByName(spark.read.parquet(*old_paths).withColumn("event_day", _day()))
    merged = merge_partial_rollups(parts).withColumn("event_day", _day())
    staging = f"{root.rstrip('/')}/_v={version}"
    (merged.hint("rebalance", F.col("event_day")).write.mode("overwrite").partitionBy("event_day").parquet(staging))
    new = {"days": {**manifest["days"], **{d: f"{staging}/event_day={d}" for d in days}},
           "last_batch": {**manifest["last_batch"], **runs}, "version": version}
    _write_manifest(spark, root, new)
    return new


def _day():
    return F.date_format("window_start", "yyyy-MM-dd")


def read_rollup(spark: SparkSession, root: str) -> DataFrame:
    """The live rollup (all days) as named by the newest manifest."""
    manifest = _read_manifest(spark, root)
    paths = [p for _, p in sorted(manifest["days"].items())]
    if not paths:
        return spark.createDataFrame([], "device_id string, network_type string, window_start timestamp, "
                                         "event_count bigint, avg_cpu double, max_cpu double, avg_memory double, "
                                         "avg_signal double, avg_throughput double, min_throughput double, "
                                         "critical_count bigint")
    return finish_rollup(spark.read.parquet(*paths))


def vacuum_rollup(spark: SparkSession, root: str, retain: int = 1) -> list[str]:
    """Delete day folders of old versions that the manifest no longer
    names, keeping the newest ``retain`` versions before the current one
    so readers holding an older manifest can finish. Returns the deleted
    paths."""
    manifest = _read_manifest(spark, root)
    live = set(manifest["days"].values())
    keep_from = manifest["version"] - retain
    fs, base, jvm = _fs(spark, root.rstrip("/"))
    if not fs.exists(base):
        return []
    deleted = []
    for vdir in fs.listStatus(base):
        name = vdir.getPath().getName()
        if not (vdir.isDirectory() and name.startswith("_v=")):
            continue
        try:
            version = int(name[len("_v="):])
        except ValueError:
            continue
        if version >= keep_from:
            continue
        remaining = 0
        for mdir in fs.listStatus(vdir.getPath()):
            path = f"{root.rstrip('/')}/{name}/{mdir.getPath().getName()}"
            if mdir.isDirectory() and mdir.getPath().getName().startswith("event_day=") and path not in live:
                fs.delete(mdir.getPath(), True)
                deleted.append(path)
            elif mdir.isDirectory():
                remaining += 1
        if remaining == 0:
            fs.delete(vdir.getPath(), True)
    return deleted
