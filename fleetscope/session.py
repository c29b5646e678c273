"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "fleetscope",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and local runs.

    On a cluster, pass no master and let spark-submit decide; every setting
    here is a plain Spark SQL conf and can be overridden by the submitter.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # commit a changelog per micro-batch instead of a full snapshot
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Instants are rendered and truncated in UTC, as the reference stores them.
    The registered queries set it; a plan keeps the zone it was made with only
    if the session keeps it, so it is not set back."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables, stream checkpoints and sinks.

    Uses the cluster's ``spark.checkpoint.dir`` (a shared file system on a
    real cluster). Only when it is unset and the master is local -- tests,
    local runs -- a fresh local folder is created and registered as the
    checkpoint dir; on any other master that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            cur = spark.sparkContext._jsc.sc().getCheckpointDir()
            d = cur.get() if cur.isDefined() else None
        except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
            d = None
    if not d:
        master = spark.conf.get("spark.master", "") or ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="fleetscope-")
        spark.conf.set("spark.checkpoint.dir", d)
        try:
            spark.sparkContext.setCheckpointDir(d)
        except Exception:  # noqa: BLE001
            pass
    return d


def new_subdir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared dir."""
    base = shared_dir(spark)
    if "://" in base and not base.startswith("file:"):
        return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    base = base[len("file:"):] if base.startswith("file:") else base
    os.makedirs(base, exist_ok=True)
    return tempfile.mkdtemp(prefix=f"{name}-", dir=base)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: this cuts its
    lineage (a lost executor costs no recomputation), it is not computed
    again, and Spark knows its size."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``fleetscope`` importable in the Python workers (what
    ``spark-submit --py-files`` does): zip the package once per application
    and add it with ``addPyFile``. Needed by the keyed-state function of the
    stream detector; a no-op when already shipped or without a SparkContext."""
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect: packages are shipped by the client
        return
    if app in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="fleetscope-pkg-"), "fleetscope.zip")
    with zipfile.ZipFile(out, "w") as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)
