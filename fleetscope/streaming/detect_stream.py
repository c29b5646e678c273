"""Incremental anomaly detection with keyed state (operator 20).

The stream is shuffled on the device: one row per reading crosses the
network (not one per metric), and one state-function call serves all the
device's metrics. The state of a device is the last ``window`` non-null
readings of each metric (integer hundredths in the exact form, doubles in
the general form), kept in Spark's state store (RocksDB in
``build_session``) and checkpointed with the query, so a restart continues
where it stopped. Within a micro-batch a device's new readings are sorted
by the arrival order and scored in numpy (exact form: prefix sums of integers;
general form: each frame by itself), giving the same numbers as the batch operator.

Order caveat: readings are applied in the order micro-batches arrive. The
stream equals the batch result when each device's readings arrive in
order (as on one partition of a keyed topic). Late readings are applied on
arrival, as the reference does.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fleetscope.functions.expressions import div_half_up
from fleetscope.operators.detect import severity_expr
from fleetscope.schemas import MIN_STD, MONITORED_METRICS, THRESHOLDS, WINDOW_SIZE


#: Frames of the general form that are in memory at once.
_FRAMES = 4096


def _half_up(x: np.ndarray) -> np.ndarray:
    """Rounded half away from zero, as Spark's ``round`` does."""
    return (np.sign(x) * np.floor(np.abs(x) + 0.5)).astype(np.int64)


def _score_metric(old: np.ndarray, new: np.ndarray, window: int, scale: int, exact: bool):
    """Frame stats of each new reading given the previous buffer."""
    vals = np.concatenate([old, new])
    pos = np.arange(len(old), len(vals))
    lo = np.maximum(0, pos - window + 1)
    n = pos + 1 - lo
    if exact:
        most = int(np.abs(vals).max(initial=0))
        # n q - s s is at most (window * most)^2; beyond BIGINT in Python's integers
        wide = (window * most) ** 2 >= 1 << 63
        if wide:
            vals, new, n = vals.astype(object), new.astype(object), n.astype(object)
        cs = np.concatenate([[0], np.cumsum(vals)])
        cq = np.concatenate([[0], np.cumsum(vals * vals)])
        s = cs[pos + 1] - cs[lo]
        q = cq[pos + 1] - cq[lo]
        root = np.sqrt((n * q - s * s).astype(np.float64))
        std = root / (n * scale).astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            z = np.abs(n * new - s).astype(np.float64) / root
        mean = s / (n * float(scale))
        if wide:
            vals, n, s, mean = vals.astype(np.int64), n.astype(np.int64), s.astype(np.int64), mean.astype(np.float64)
    else:
        # mean and squared deviations of each frame by itself: no value
        # outside a frame touches its numbers, however large it is
        padded = np.concatenate([np.full(window - 1, np.nan), vals])
        frames = np.lib.stride_tricks.sliding_window_view(padded, window)[len(old):]
        mean, std = np.empty(len(new)), np.empty(len(new))
        for at in range(0, len(new), _FRAMES):
            part = frames[at:at + _FRAMES]
            mean[at:at + _FRAMES] = np.nanmean(part, axis=1)
            std[at:at + _FRAMES] = np.sqrt(np.nanmean((part - mean[at:at + _FRAMES, None]) ** 2, axis=1))
        s = np.zeros(len(new), dtype=np.int64)
        with np.errstate(divide="ignore", invalid="ignore"):
            z = np.abs(new - mean) / std
    return vals[-window:], n, s, mean, z, std


#: Numbers of one alert in the scorer's output, besides the carried ones.
_LONGS, _DOUBLES = ["metric", "c", "n", "s"], ["x", "mean", "z", "std"]
_NULLS = "_nulls"


def _to_long(c: str, t: T.DataType):
    """A column as BIGINT and the way back, or None where its type has no exact one."""
    if isinstance(t, T.TimestampType):
        return F.unix_micros(F.col(c)), F.timestamp_micros
    if isinstance(t, T.DateType):
        return F.unix_date(F.col(c)).cast("long"), lambda x: F.date_from_unix_date(x.cast("int"))
    if isinstance(t, T.IntegralType):
        return F.col(c).cast("long"), lambda x: x.cast(t)
    return None


def _objects(x: pd.Series) -> list:
    """The values as Python objects, which an array of any type takes (not so numpy's times)."""
    return x.astype(object).where(x.notna(), None).tolist()


def _scorer(metrics: list[str], order_cols: list[str], packed: list[str], carry: list[str], window: int, scale: int,
            exact: bool, warn_by_metric: dict, timeout_ms: int | None):
    """``packed`` columns come as numbers of the array ``_i``, the last of which has a bit for each that is null; the other
    ``carry`` columns come as they are, the metrics as the array ``_x``. A call's alerts leave as one row of arrays. A call
    serves one device, and each column of its input or output costs it as much as scoring some thousand readings."""
    ready_at = window // 2
    dtype = np.int64 if exact else np.float64
    alone = [c for c in carry if c not in packed]
    out_cols = pd.Index(["device_id", *alone, "_l", "_d"])

    def score(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # pandas warns inside Spark's Arrow reader when a chunk is empty.
        warnings.filterwarnings("ignore", category=FutureWarning)
        if state.hasTimedOut:
            state.remove()
            return
        chunks = [b for b in batches if len(b)]
        if not chunks:
            return
        pdf = chunks[0] if len(chunks) == 1 else pd.concat(chunks, ignore_index=True)
        numbers = np.concatenate(pdf["_i"].to_numpy()).reshape(len(pdf), -1)
        readings = np.concatenate(pdf["_x"].to_numpy()).astype(np.float64, copy=False).reshape(len(pdf), -1)
        keys = []
        for c in reversed(order_cols):
            keys.append(numbers[:, packed.index(c)] if c in packed else pdf[c].to_numpy())
            if c in packed and numbers[:, -1].any():  # nulls come last
                keys.append(numbers[:, -1] >> packed.index(c) & 1)
        order = np.lexsort(keys)
        numbers, readings = numbers[order], readings[order]
        bufs = list(state.get) if state.exists else [None] * len(metrics)
        new_bufs, parts = [], []
        for i, m in enumerate(metrics):
            x = readings[:, i]
            ok = ~np.isnan(x)
            prev = bufs[i] if bufs[i] is not None else []
            if not ok.any():
                new_bufs.append(list(prev))
                continue
            idx = np.flatnonzero(ok)
            xv = x[idx]
            new = _half_up(xv * scale) if exact else xv
            buf, n, s, mean, z, std = _score_metric(np.asarray(prev, dtype=dtype), new, window,
                                                    scale, exact)
            new_bufs.append(buf.tolist())
            hit = np.flatnonzero((n >= ready_at) & (std >= MIN_STD) & np.isfinite(z)
                                 & (z >= warn_by_metric[m]))
            if len(hit):
                c = new[hit] if exact else np.zeros(len(hit), np.int64)
                parts.append((idx[hit], np.column_stack([np.full(len(hit), i), c, n[hit], s[hit], numbers[idx[hit]]]),
                              np.column_stack([xv[hit], mean[hit], z[hit], std[hit]])))
        state.update(tuple(new_bufs))
        if timeout_ms:
            state.setTimeoutDuration(timeout_ms)
        if not parts:
            return
        rows = np.concatenate([p[0] for p in parts])
        out = np.empty((1, len(out_cols)), dtype=object)
        out[0, :] = [key[0], *[_objects(pdf[c].iloc[order[rows]]) for c in alone],
                     np.concatenate([p[1] for p in parts]).ravel(), np.concatenate([p[2] for p in parts]).ravel()]
        yield pd.DataFrame(out, columns=out_cols)

    return score


def detect_anomalies_stream(readings: DataFrame, *, device_col: str = "device_id",
                            time_col: str = "event_timestamp",
                            order_cols: list[str] | None = None,
                            metrics: list[str] = MONITORED_METRICS,
                            thresholds: dict = THRESHOLDS, window: int = WINDOW_SIZE,
                            exact: bool = True, scale: int = 100,
                            state_timeout: str | None = None,
                            keep: list[str] | None = None) -> DataFrame:
    """Streaming readings -> alert rows (append mode), same columns and
    numbers as ``detect_anomalies``. ``state_timeout`` (e.g. "7 days",
    processing time) drops devices that stay silent; off by default, as in
    the reference where devices never expire."""
    from fleetscope.session import ship_package
    ship_package(readings.sparkSession)  # the state function runs in Python workers
    if exact and 10_000 % scale:
        raise ValueError("scale must divide 10,000; use exact=False for other data")
    order_cols = order_cols or [time_col, "event_id"]
    keep = keep or []
    carry = list(dict.fromkeys([*order_cols, time_col, *keep]))
    # the carried types, as the function's columns and arrays are named apart from them
    types = {f.name: f.dataType for f in readings.select(*carry).schema.fields}
    as_long = {c: _to_long(c, types[c]) for c in carry}
    packed = [c for c in carry if as_long[c]][:62]
    alone = [c for c in carry if c not in packed]
    nulls = F.lit(0).cast("long")
    for j, c in enumerate(packed):
        nulls = nulls + F.when(F.col(c).isNull(), F.lit(1 << j)).otherwise(F.lit(0)).cast("long")
    wide = readings.select(
        F.col(device_col).alias("device_id"), *alone, F.array(*[F.col(m).cast("double") for m in metrics]).alias("_x"),
        F.array(*[F.coalesce(as_long[c][0], F.lit(0).cast("long")) for c in packed], nulls).alias("_i"))
    longs = T.ArrayType(T.LongType())
    out_schema = T.StructType(
        [T.StructField("device_id", wide.schema["device_id"].dataType)]
        + [T.StructField(c, T.ArrayType(types[c])) for c in alone]
        + [T.StructField("_l", longs), T.StructField("_d", T.ArrayType(T.DoubleType()))])
    elem = T.LongType() if exact else T.DoubleType()
    state_schema = T.StructType([T.StructField(f"buf{i}", T.ArrayType(elem)) for i in range(len(metrics))])
    timeout_ms = _duration_ms(state_timeout) if state_timeout else None
    warn_by_metric = {m: float(thresholds[m][0]) for m in metrics}
    fn = _scorer(metrics, order_cols, packed, carry, window, scale, exact, warn_by_metric, timeout_ms)
    scored = wide.groupBy("device_id").applyInPandasWithState(
        fn, out_schema, state_schema, "append",
        GroupStateTimeout.ProcessingTimeTimeout if timeout_ms else GroupStateTimeout.NoTimeout)
    places = F.sequence(F.lit(0), (F.size("_d") / len(_DOUBLES)).cast("int") - 1)
    hits = scored.select("*", F.explode(places).alias("_j"))
    number = lambda a, names, c: F.get(F.col(a), F.col("_j") * len(names) + names.index(c))
    longs_of = [*_LONGS, *packed, _NULLS]
    null_at = number("_l", longs_of, _NULLS)
    scored = hits.select(
        "device_id", F.get(F.array(*[F.lit(m) for m in metrics]), number("_l", longs_of, "metric").cast("int")).alias("metric"),
        *[F.get(F.col(c), F.col("_j")).alias(c) if c in alone else
          F.when(null_at.bitwiseAND(F.lit(1 << packed.index(c)).cast("long")) == 0,
                 as_long[c][1](number("_l", longs_of, c))).alias(c) for c in carry],
        *[number("_l", longs_of, c).alias(c) for c in ("c", "n", "s")],
        *[number("_d", _DOUBLES, c).alias(c) for c in _DOUBLES])
    flagged = scored.withColumn("severity", severity_expr(thresholds)).where(F.col("severity").isNotNull())
    if exact:
        mean4 = div_half_up(F.col("s") * (10_000 // scale), F.col("n")) / F.lit(10_000.0)
        observed = F.col("c").cast("double") / F.lit(float(scale))
    else:
        mean4 = F.round("mean", 4)
        observed = F.round(F.col("x"), 4)
    return flagged.select(
        F.col("device_id"), F.col(time_col).alias("detected_at"), "metric",
        observed.alias("observed_value"), mean4.alias("rolling_mean"),
        F.round("std", 4).alias("rolling_std_dev"), F.round("z", 4).alias("z_score"),
        "severity", *keep)


def _duration_ms(text: str) -> int:
    num, unit = text.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
            "day": 86400, "days": 86400}[unit]
    return int(math.floor(float(num) * mult * 1000))
