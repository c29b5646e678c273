"""Sliding-window z-score anomaly detection (operators 15-19, 21).

Semantics (per device and metric, in arrival order ``order_cols``):
keep the last ``window`` non-null readings *including the current one*;
score only when at least ``window // 2`` readings are held and the
population standard deviation is at least 1e-6; z = |x - mean| / std;
critical if z >= critical threshold, else warning if z >= warning
threshold, else no alert.

Plan at scale
-------------
A plain ``Window.partitionBy(device, metric)`` would put every reading of
a hot device into one task. All devices take one path instead:

0. blocks of about ``target_rows`` consecutive readings of a device are
   numbered (see blocks.py);
1. readings are shuffled once, *before* the unpivot (one row per event, not
   one per metric), on (device, block), or on runs of blocks where these are
   small; the window on (device, metric, block) needs no further shuffle. The
   frame evaluated inside a block is already final for the rows of a device's
   first block and for rows with at least ``window - 1`` predecessors in their
   block; blocks without such rows are not unpivoted here;
2. only the *edge* readings of devices with several blocks -- of each metric,
   the first and the last ``window - 1`` of every block -- are shuffled on the
   device, again before the unpivot and with nothing but their place, time and
   readings, and the frame is evaluated again over them. The last
   ``window - 1`` rows before any block are all edge rows, so the result is
   exact for the head rows.

The union of the final rows of (1) and the head rows of (2) is the whole,
exact result. A task of (1) holds about ``target_rows`` readings (or
``blocks.PART_ROWS``, if that is more), and one of (2) at most
``2 (window - 1)`` rows per block and metric of a device.

Numbers
-------
``exact=True`` (default) works on integer hundredths c = round(100 x):
n, S = sum c, Q = sum c^2 are exact, mean = S / 100n,
std = sqrt(nQ - S^2) / 100n, z = |nc - S| / sqrt(nQ - S^2). Any engine
gives the same bits. ``exact=False`` uses ``avg``/``stddev_pop`` on
doubles for data that is not 2-decimal.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.functions.expressions import div_half_up
from fleetscope.operators.blocks import DEFAULT_TARGET_ROWS, assign_blocks, deal_blocks
from fleetscope.schemas import MIN_STD, MONITORED_METRICS, THRESHOLDS, WINDOW_SIZE


#: Blocks of a part of a key in the edge pass of ``rolling_stats``.
PART_BLOCKS = 4
#: Windows of so many rows or more sum up in decimals.
PREFIX_SUMS_FROM = 512


# -- operator 15 -----------------------------------------------------------
def unpivot_metrics(df: DataFrame, ids: list[str], metrics: list[str] = MONITORED_METRICS,
                    value_col: str = "x") -> DataFrame:
    """One row per (reading, metric); null readings are dropped so they do
    not take a window slot."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(value_col))
                      for m in metrics])
    # inline(array(struct)) rather than unpivot(): the same rows, but as a
    # Generate it canonicalizes stably, so when one plan reads this twice
    # (detect's union) Spark reuses the shuffle instead of repeating it.
    return (df.select(*ids, F.inline(pairs))
            .where(F.col(value_col).isNotNull()))


def _frame_aggs(w_order, value: str, exact: bool, window: int) -> list[dict]:
    """Window columns n, s, q (exact) or n, mean, std (general) over the
    last ``window`` rows of ``w_order``. Exact: running sums less the running
    sums ``window`` rows back, whose cost does not depend on the window (of a
    bounded frame Spark adds up all rows again for each row). Squares over a
    long block leave BIGINT: their upper and lower 32 bits are summed up apart,
    and for large windows, whose sums leave it too, as decimal(38,0)."""
    frame = w_order.rowsBetween(-(window - 1), Window.currentRow)
    so_far = w_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def in_frame(column: str, none: Column) -> Column:
        return F.col(column) - F.coalesce(F.lag(column, window).over(w_order), none)

    if exact and window >= PREFIX_SUMS_FROM:
        c, none = F.col("_c").cast("decimal(19,0)"), F.lit(0).cast("decimal(38,0)")
        return [{"_ps": F.sum(c).over(so_far).cast("decimal(38,0)"), "_pq": F.sum(c * c).over(so_far).cast("decimal(38,0)"),
                 "_pn": F.row_number().over(w_order)},
                {"n": F.least("_pn", F.lit(window)).cast("long"), "s": in_frame("_ps", none).cast("decimal(38,0)").cast("long"),
                 "q": in_frame("_pq", none).cast("decimal(38,0)")}]
    if exact:
        # c c is a BIGINT, so that sums of c and of halves of c c are, too, over 2^31 rows
        square, none = F.col("_c") * F.col("_c"), F.lit(0).cast("long")
        high, low = F.shiftright(square, 32), square.bitwiseAND(F.lit(2 ** 32 - 1))
        known = in_frame("_pk", none) > 0  # else all values of the frame are null
        return [{"_ps": F.sum("_c").over(so_far), "_ph": F.sum(high).over(so_far), "_pl": F.sum(low).over(so_far),
                 "_pk": F.count("_c").over(so_far), "_pn": F.row_number().over(w_order)},
                {"n": F.least("_pn", F.lit(window)).cast("long"), "s": F.when(known, in_frame("_ps", none)),
                 "q": F.when(known, in_frame("_ph", none) * F.lit(2 ** 32) + in_frame("_pl", none))}]
    return [{"n": F.count(F.lit(1)).over(frame),
             "mean": F.avg(value).over(frame),
             "std": F.stddev_pop(value).over(frame)}]


def _apply(df: DataFrame, steps: list[dict]) -> DataFrame:
    for step in steps:
        df = df.withColumns(step)
    return df.drop("_ps", "_pq", "_ph", "_pl", "_pk", "_pn")


# -- operator 16 -----------------------------------------------------------
def hundredths(value: Column, scale: int) -> Column:
    """``value * scale`` as an integer; fails where it is not one, instead
    of scoring a rounded value."""
    scaled = value * scale
    whole = F.round(scaled)
    message = F.concat(F.lit(f"not a multiple of 1/{scale}, use exact=False: "), value.cast("string"))
    off = F.abs(scaled - whole) > F.greatest(F.lit(1e-6), F.abs(whole) * 1e-12)
    return F.when(off, F.raise_error(message).cast("long")).otherwise(whole.cast("long"))


def rolling_stats(long: DataFrame, keys: list[str], order_cols: list[str], *,
                  value_col: str = "x", window: int = WINDOW_SIZE, exact: bool = True,
                  scale: int = 100, target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Count, mean and population std over the last ``window`` rows of each
    key (current row included). Exact form adds ``_c`` (scaled integer),
    ``n``, ``s``, ``q``; general form adds ``n``, ``mean``, ``std``.

    Keys are cut into blocks of about ``target_rows`` rows and stitched by
    the edge pass, in parts of some blocks."""
    if window < 1:
        raise ValueError("window must be >= 1")
    long = assign_blocks(long, keys, order_cols, target_rows, before=True).repartition(*keys, "_blk")
    base = long.withColumn("_c", hundredths(F.col(value_col), scale)) if exact else long
    order = [F.col(c).asc() for c in order_cols]
    w_blk = Window.partitionBy(*keys, "_blk").orderBy(*order)
    whole = w_blk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stage1 = _apply(base.withColumns({"_r": F.row_number().over(w_blk),
                                      "_m": F.count(F.lit(1)).over(whole)}),
                    _frame_aggs(w_blk, value_col, exact, window))
    stats = ["n", "s", "q"] if exact else ["n", "mean", "std"]
    out_cols = [c for c in base.columns if c not in ("_blk", "_split", "_before")] + stats
    # Final from stage 1: every row of a key's first block, and rows with a
    # full frame inside their block. (A key that is not split only has a first
    # block; naming _split here too gives both branches the same columns, so
    # that Spark runs the shuffle once for both.)
    first = ~F.col("_split") | (F.col("_blk") == 0)
    inner = stage1.where(first | (F.col("_r") >= window)).select(*out_cols)
    # Edge rows of split keys: first and last (window - 1) of every block. By the number of rows before it, a row belongs
    # to a part of its key, and the last rows of a part stand before the next one's too, as so many rows count for its first rows
    part_rows = PART_BLOCKS * max(target_rows, window)
    at = F.min("_before").over(whole) + F.col("_r") - 1
    edge_src = stage1.withColumn("_at", at)
    edge_src = edge_src.where(F.col("_split") & ((F.col("_r") < window) | (F.col("_m") - F.col("_r") < window - 1)))
    part = F.floor(F.col("_at") / part_rows)
    edge_src = edge_src.select(*base.columns, "_r", part.alias("_own"), F.explode(F.when(
        F.col("_at") % part_rows > part_rows - window, F.array(part, part + 1)).otherwise(F.array(part))).alias("_part"))
    w_key = Window.partitionBy(*keys, "_part").orderBy(*order)
    edge = _apply(edge_src, _frame_aggs(w_key, value_col, exact, window))
    heads = edge.where((F.col("_blk") > 0) & (F.col("_r") < window) & (F.col("_part") == F.col("_own")))
    return inner.unionByName(heads.select(*out_cols))


def blocked_stats(wide: DataFrame, device_col: str, order_cols: list[str], metrics: list[str], carry: list[str], *,
                  window: int, exact: bool, scale: int) -> DataFrame:
    """The statistics of ``rolling_stats`` by device and metric, and the columns ``carry``, for readings that are dealt out
    in blocks (see ``deal_blocks``). The edge readings are shuffled before the unpivot: a row per event, with its metrics
    as integers, its place instead of the order columns, and which metrics it is a head row of."""
    if window < 1:
        raise ValueError("window must be >= 1")
    value = "_c" if exact else "x"
    part = [c for c in ("_part",) if c in wide.columns]
    order = ["_i"] if part else order_cols
    ids = list(dict.fromkeys([device_col, *order, *carry]))
    readings = {m: F.col(m).cast("double") for m in metrics}
    w_blk = Window.partitionBy(device_col, *part, "_blk").orderBy(*order)
    so_far = w_blk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w_blk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    places = range(len(metrics))
    numbered = wide.select(*ids, *part, "_blk", "_split", *[
        (hundredths(x, scale) if exact else x).alias(f"_v{j}") for j, x in enumerate(readings.values())])
    # _r and _m: of a metric, the readings of the block up to this row, and all
    numbered = numbered.withColumns({f"_r{j}": F.count(f"_v{j}").over(so_far) for j in places}
                                    | {f"_m{j}": F.count(f"_v{j}").over(whole) for j in places})

    def long(rows: DataFrame, names: list[str], values: list[Column], more: list[dict]) -> DataFrame:
        pairs = [F.struct(F.lit(m).alias("metric"), v.alias(value), *[c.alias(n) for n, c in extra.items()])
                 for m, v, extra in zip(metrics, values, more)]
        return rows.select(*names, F.inline(F.array(*pairs))).where(F.col(value).isNotNull())

    stats = ["n", "s", "q"] if exact else ["n", "mean", "std"]
    out_cols = [*dict.fromkeys([device_col, *carry]), "metric", value, *stats]
    first = ~F.col("_split") | (F.col("_blk") == 0)
    held = [F.when(first | (F.col(f"_m{j}") >= window), F.col(f"_v{j}")) for j in places]
    inner = long(numbered, [*ids, *part, "_blk", "_split"], held, [{}] * len(metrics))
    inner = _apply(inner, _frame_aggs(Window.partitionBy(device_col, "metric", *part, "_blk").orderBy(*order), value, exact, window))
    inner = inner.where(first | (F.col("n") >= window))
    is_edge = [F.col(f"_v{j}").isNotNull() & ((F.col(f"_r{j}") < window) | (F.col(f"_m{j}") - F.col(f"_r{j}") < window - 1))
               for j in places]
    heads = [((F.col("_blk") > 0) & (F.col(f"_r{j}") < window)).alias(f"_h{j}") for j in places]
    edges = numbered.where(F.col("_split") & reduce(or_, is_edge)).select(
        *ids, "_blk", *[F.when(e, F.col(f"_v{j}")).alias(f"_v{j}") for j, e in enumerate(is_edge)], *heads)
    # numbered by device, so that they are shuffled here and as they are
    edges = edges.withColumn("_e", F.row_number().over(Window.partitionBy(device_col).orderBy("_blk", *order)))
    edges = long(edges, [*dict.fromkeys([device_col, *carry]), "_e"], [F.col(f"_v{j}") for j in places],
                 [{"_head": F.col(f"_h{j}")} for j in places])
    edges = _apply(edges, _frame_aggs(Window.partitionBy(device_col, "metric").orderBy("_e"), value, exact, window))
    return inner.select(*out_cols).unionByName(edges.where("_head").select(*out_cols))


def stats_columns(window: int = WINDOW_SIZE, exact: bool = True, scale: int = 100) -> dict:
    """Derived columns of ``rolling_stats``: mean, std, the guard and z."""
    if exact:
        n, s, q = F.col("n"), F.col("s"), F.col("q")
        # in BIGINT where n q fits it (s s is never more); readings near the limits of their type need decimals
        wide = lambda c: c.cast("decimal(38,0)")
        d = F.when(q <= (2 ** 63 - 1) // window, (n * q.cast("long") - s * s).cast("double")).otherwise(
            (wide(wide(n) * wide(q)) - wide(wide(s) * wide(s))).cast("double"))
        root = F.sqrt(d)
        std = root / (n * scale)
        mean = s / (n * F.lit(float(scale)))
        dev = F.abs(n * F.col("_c") - s).cast("double") / root
    else:
        std = F.col("std")
        mean = F.col("mean")
        dev = F.abs(F.col("x") - F.col("mean")) / F.col("std")
    ready = F.col("n") >= (window // 2)
    scored = ready & (std >= F.lit(MIN_STD))
    return {"mean": mean, "std": std, "ready": ready, "z": F.when(scored, dev)}


# -- operator 17 -----------------------------------------------------------
def zscore_guarded(stats: DataFrame, window: int = WINDOW_SIZE, exact: bool = True,
                   scale: int = 100) -> DataFrame:
    """Adds ``rolling_mean_raw``/``rolling_std_raw`` (doubles) and ``z``
    (NULL while warming up or on a flat window)."""
    cols = stats_columns(window, exact, scale)
    return (stats.withColumn("rolling_mean_raw", cols["mean"])
            .withColumn("rolling_std_raw", cols["std"])
            .withColumn("z", cols["z"]))


# -- operator 18 -----------------------------------------------------------
def severity_expr(thresholds: dict = THRESHOLDS, metric_col: str = "metric",
                  z_col: str = "z") -> Column:
    """critical if z >= critical threshold, warning if z >= warning
    threshold (unrounded z, inclusive), else NULL."""
    pairs_w, pairs_c = [], []
    for m, (warn, crit) in thresholds.items():
        pairs_w += [F.lit(m), F.lit(float(warn))]
        pairs_c += [F.lit(m), F.lit(float(crit))]
    warn = F.create_map(*pairs_w)[F.col(metric_col)]
    crit = F.create_map(*pairs_c)[F.col(metric_col)]
    z = F.col(z_col)
    return F.when(z >= crit, F.lit("critical")).when(z >= warn, F.lit("warning"))


def severity_for(scored: DataFrame, thresholds: dict | DataFrame = THRESHOLDS, **columns) -> DataFrame:
    """``thresholds``: a mapping metric -> (warning, critical), or a relation (see ``severity_by_table``)."""
    if isinstance(thresholds, dict):
        return scored.withColumn("severity", severity_expr(thresholds))
    return severity_by_table(scored, thresholds, **columns)


def severity_by_table(scored: DataFrame, thresholds: DataFrame, metrics: list[str] = MONITORED_METRICS, *,
                      device_col: str = "device_id", metric_col: str = "metric", z_col: str = "z") -> DataFrame:
    """Adds ``severity`` by a relation (metric, warning, critical, optionally
    device_id) instead of a fixed mapping.

    A row with a device holds for that device and metric and goes before the
    metric's own row (no device, or a null one). A metric without a row is
    never an alert; a null threshold is never reached; of several rows for one
    key the lowest thresholds count; rows without a metric hold for nothing.

    The metrics' own rows are at most one for each of ``metrics`` and so are
    broadcast; how the rows of devices are joined is left to Spark."""
    limits = [F.min("warning").cast("double").alias("_warning"), F.min("critical").cast("double").alias("_critical")]
    by_device = "device_id" in thresholds.columns
    own = thresholds.where(F.col("device_id").isNull()) if by_device else thresholds
    own = own.where(F.col("metric").isin(*metrics)).groupBy(F.col("metric").alias("_metric")).agg(*limits)
    out = scored.join(F.broadcast(own), F.col(metric_col) == F.col("_metric"), "left").drop("_metric")
    warning, critical = F.col("_warning"), F.col("_critical")
    drop = ["_warning", "_critical"]
    if by_device:
        special = (thresholds.where(F.col("device_id").isNotNull() & F.col("metric").isNotNull())
                   .groupBy(F.col("device_id").alias("_device"), F.col("metric").alias("_metric"))
                   .agg(*[c.alias(n) for c, n in zip(limits, ("_device_warning", "_device_critical"))]))
        out = out.join(special, (F.col(device_col) == F.col("_device")) & (F.col(metric_col) == F.col("_metric")), "left")
        has = F.col("_device").isNotNull()
        warning = F.when(has, F.col("_device_warning")).otherwise(warning)
        critical = F.when(has, F.col("_device_critical")).otherwise(critical)
        drop += ["_device", "_metric", "_device_warning", "_device_critical"]
    z = F.col(z_col)
    return (out.withColumn("severity", F.when(z >= critical, F.lit("critical")).when(z >= warning, F.lit("warning")))
            .drop(*drop))


# -- operator 19 -----------------------------------------------------------
def detect_anomalies(df: DataFrame, *, device_col: str = "device_id",
                     time_col: str = "event_timestamp",
                     order_cols: list[str] | None = None,
                     metrics: list[str] = MONITORED_METRICS,
                     thresholds: dict | DataFrame = THRESHOLDS, window: int = WINDOW_SIZE,
                     exact: bool = True, scale: int = 100,
                     target_rows: int = DEFAULT_TARGET_ROWS,
                     keep: list[str] | None = None) -> DataFrame:
    """Readings table -> alert rows (the stored alert columns).

    ``order_cols`` is the arrival order, default (time_col, event_id).
    Outputs are rounded to 4 places: mean exactly half-up from integers
    (exact form), std and z with ``round``. ``keep`` carries extra input
    columns (e.g. ``event_id``) into the result.
    """
    order_cols = order_cols or [time_col, "event_id"]
    # Blocks are decided on the readings, and the readings are shuffled once
    # by block *before* the 4x unpivot: a window on (device, metric, block) is
    # satisfied by that partitioning, so the long rows are never shuffled.
    wide = deal_blocks(df, [device_col], order_cols, target_rows)
    return score_blocked(wide, device_col=device_col, time_col=time_col, order_cols=order_cols, metrics=metrics,
                         thresholds=thresholds, window=window, exact=exact, scale=scale, keep=keep)


def score_blocked(wide: DataFrame, *, device_col: str, time_col: str, order_cols: list[str], metrics: list[str],
                  thresholds: dict | DataFrame, window: int, exact: bool, scale: int, keep: list[str] | None) -> DataFrame:
    """``detect_anomalies`` of readings that have ``_blk`` and ``_split`` and are partitioned by (device, ``_blk``), or that
    ``deal_blocks`` has dealt out."""
    keep = keep or []
    if exact and 10_000 % scale:
        raise ValueError("scale must divide 10,000; use exact=False for other data")
    stats = blocked_stats(wide, device_col, order_cols, metrics, [time_col, *keep], window=window, exact=exact, scale=scale)
    derived = stats_columns(window, exact, scale)
    # inline is a barrier: z and std are computed once for each row, and not written out again in every filter and column that
    # reads them, which makes generated methods too long to be compiled
    scored = stats.select("*", F.inline(F.array(F.struct(derived["z"].alias("z"), derived["std"].alias("_std")))))
    scored = scored.where(F.col("z").isNotNull())
    if isinstance(thresholds, dict):
        flagged = severity_for(scored, thresholds)
    else:
        flagged = severity_by_table(scored, thresholds, metrics, device_col=device_col)
    flagged = flagged.where(F.col("severity").isNotNull())
    if exact:
        per_unit = 10_000 // scale
        mean4 = div_half_up(F.col("s") * per_unit, F.col("n")) / F.lit(10_000.0)
        observed = F.col("_c").cast("double") / F.lit(float(scale))
    else:
        mean4 = F.round(F.col("mean"), 4)
        observed = F.round(F.col("x"), 4)
    return flagged.select(
        F.col(device_col).alias("device_id"),
        F.col(time_col).alias("detected_at"),
        "metric",
        observed.alias("observed_value"),
        mean4.alias("rolling_mean"),
        F.round("_std", 4).alias("rolling_std_dev"),
        F.round(F.col("z"), 4).alias("z_score"),
        "severity",
        *keep,
    )


# -- operator 21 -----------------------------------------------------------
def tracked_devices(df: DataFrame, metrics: list[str] = MONITORED_METRICS,
                    device_col: str = "device_id") -> DataFrame:
    """Devices with at least one non-null monitored reading (state exists)."""
    any_reading = F.lit(False)
    for m in metrics:
        any_reading = any_reading | F.col(m).isNotNull()
    return (df.where(any_reading)
            .agg(F.count_distinct(device_col).alias("devices_tracked")))
