"""Cutting long keys into blocks of consecutive rows, by row counts.

A window per key puts all rows of a key into one task. ``assign_blocks``
numbers blocks of about ``target_rows`` consecutive rows (in the sort order)
within every key, whatever the rate of its rows and without a limit on the
number of keys:

1. rows are counted per key; those of keys with more than ``target_rows`` are
   counted per (key, coarse bucket of the first order column), and the counts
   are summed up; a bucket's block is the number of rows before it divided by
   ``target_rows``;
2. a bucket that alone holds more than ``target_rows`` is counted again by
   the next finer level (day, hour, second, exact value, next order column,
   ...), so a burst is split too;
3. the blocks are joined back on (key, bucket). All other rows are block 0.

The block table has a row per (key, bucket) of the split keys only and is
written to the shared folder first, so that Spark sees its size: it is
broadcast when it is small and joined by a shuffle when it is not.

Blocks of few rows would make that table about as long as the rows, and each
of its joins would shuffle all of them. ``deal_blocks`` therefore assigns
*parts* of many blocks so, shuffles the rows once, and numbers the blocks by
the rows' places in their part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.session import written

DEFAULT_TARGET_ROWS = 1_000_000
#: Smaller blocks than this are dealt out in parts of about so many rows.
PART_ROWS = DEFAULT_TARGET_ROWS


def _levels(df: DataFrame, order_cols: list[str]) -> list[Column]:
    """Bucket values from coarse to fine; each refines the one before it in
    the sort order."""
    first, dtype = F.col(order_cols[0]), df.schema[order_cols[0]].dataType
    if isinstance(dtype, T.TimestampType):
        micros = F.unix_micros(first)
        start = [F.floor(micros / (s * 1_000_000)) for s in (86_400, 3600, 1)]
    elif isinstance(dtype, T.TimestampNTZType):
        # no step through a time zone, so that buckets never go backwards
        start = [F.to_date(first), F.hour(first), F.date_trunc("second", first)]
    elif isinstance(dtype, T.NumericType):
        start = [F.floor(first / 2 ** 20), F.floor(first / 1024)]
    elif isinstance(dtype, T.DateType):
        start = [F.floor(F.unix_date(first) / 32)]
    else:
        start = []
    return [*start, first, *[F.col(c) for c in order_cols[1:]]]


def _joined(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Join on equal ``cols``, where null equals null; the columns come from ``left``."""
    renamed = right.withColumnsRenamed({c: f"_of_{c}" for c in cols})
    on = [left[c].eqNullSafe(renamed[f"_of_{c}"]) for c in cols]
    return left.join(renamed, on, how).drop(*[f"_of_{c}" for c in cols])


def assign_blocks(df: DataFrame, keys: list[str], order_cols: list[str],
                  target_rows: int = DEFAULT_TARGET_ROWS, before: bool = False) -> DataFrame:
    """Adds ``_blk`` (long, 0 for the first rows of a key, growing in the
    order of ``order_cols``) and ``_split`` (has the key several blocks?); with
    ``before`` also ``_before``, the least of which in a block is the number of
    the key's rows before the block (0 for keys that are not split).

    Rows that are equal in all order columns stay in one block. A null key is
    a key, and null order values (which sort first) are split like others."""
    if target_rows < 1:
        raise ValueError("target_rows must be >= 1")
    levels = _levels(df, order_cols)
    names = [f"_l{i}" for i in range(len(levels))]
    slim = df.select(*keys, *[c.alias(n) for c, n in zip(levels, names)])
    # 0, but not a constant: Spark would drop a constant _blk from the keys of
    # the window and no longer see that a shuffle on (key, _blk) satisfies it
    zero = F.pmod(F.hash(*keys), F.lit(1)).cast("long")
    whole = df.withColumns({"_blk": zero, "_split": F.lit(False), **({"_before": zero} if before else {})})
    # a table of so few rows has no larger key (of Parquet, the rows are counted from the footers)
    if df.count() <= target_rows:
        return whole
    # the coarsest bucket is the key itself
    large = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > target_rows)
             .select(*keys, F.lit(0).cast("long").alias("_base")))
    if large.isEmpty():
        return whole
    large = written(large, "blocks")
    out = df.withColumns(dict(zip(names, levels)))
    blocks, rows_before = [], []
    for i in range(len(levels)):
        own = names[:i + 1]
        counts = (_joined(slim, large, [*keys, *names[:i]]).groupBy(*keys, *own)
                  .agg(F.count(F.lit(1)).alias("_n"), F.first("_base").alias("_base")))
        # a window over the buckets of one larger bucket, not over rows
        running = (Window.partitionBy(*keys, *own[:-1]).orderBy(own[-1])
                   .rowsBetween(Window.unboundedPreceding, -1))
        counts = counts.withColumn("_before", F.col("_base") + F.coalesce(F.sum("_n").over(running), F.lit(0)))
        found = written(counts.select(*keys, *own, F.floor(F.col("_before") / target_rows).alias(f"_b{i}"),
                                      "_n", "_before"), "blocks")
        joined = found.drop("_n").withColumnRenamed("_before", f"_n{i}") if before else found.drop("_n", "_before")
        out = _joined(out, joined, [*keys, *own], "left")
        blocks.insert(0, F.col(f"_b{i}"))
        rows_before.insert(0, F.col(f"_n{i}"))
        large = found.where(F.col("_n") > target_rows).select(*keys, *own, F.col("_before").alias("_base"))
        if large.isEmpty():
            break
    added = {"_blk": F.coalesce(*blocks, zero), "_split": F.col("_b0").isNotNull()}
    if before:
        added["_before"] = F.coalesce(*rows_before, zero)
    return out.withColumns(added).select(*df.columns, *added)


def deal_blocks(df: DataFrame, keys: list[str], order_cols: list[str],
                target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """``assign_blocks`` with the rows shuffled so that a block is in one task.

    Blocks of ``PART_ROWS`` rows or more are dealt out by (keys, ``_blk``).
    Smaller ones are by (keys, ``_part``), a part being a run of blocks with
    about ``PART_ROWS`` rows; such rows also have ``_part`` and ``_i``, their
    place in it. Rows that are equal in all order columns stay in one block."""
    if target_rows < 1:
        raise ValueError("target_rows must be >= 1")
    if target_rows >= PART_ROWS:
        return assign_blocks(df, keys, order_cols, target_rows).repartition(*keys, "_blk")
    parts = assign_blocks(df, keys, order_cols, PART_ROWS).withColumnRenamed("_blk", "_part").repartition(*keys, "_part")
    w = Window.partitionBy(*keys, "_part").orderBy(*[F.col(c).asc() for c in order_cols])
    rows = F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    block = F.floor((F.rank().over(w) - 1) / target_rows)
    return parts.withColumns({"_i": F.row_number().over(w), "_blk": F.col("_part") * F.lit(2 ** 32) + block,
                              "_split": F.col("_split") | (rows > target_rows)})
