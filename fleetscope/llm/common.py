"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.session import written  # noqa: F401 - the operators take it from here

#: Rows and text bytes that one Python step holds at a time; a longer text is one slice of its own.
SLICE_ROWS = 1024
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds


def hashed_share(key: Column, share: float) -> Column:
    """True for about ``share`` of the rows, chosen by a hash of ``key`` alone."""
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))


def mapped(texts: pa.Array, f: Callable[[str | None], object], kind: pa.DataType) -> pa.Array:
    """``f`` of every text, a slice of rows at a time, for Arrow UDFs."""
    out: list = []
    for at in range(0, len(texts), SLICE_ROWS // 4):
        out.extend(map(f, texts.slice(at, SLICE_ROWS // 4).to_pylist()))
    return pa.array(out, kind)


def slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds at most SLICE_ROWS rows and about SLICE_BYTES of column ``text``."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(text)
        if pa.types.is_list(col.type):
            sizes = 4 * np.asarray(pc.fill_null(col.value_lengths(), 0), dtype=np.int64)
        else:
            sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < n:
            base = ends[at - 1] if at else 0
            stop = int(np.searchsorted(ends, base + SLICE_BYTES, side="right"))
            stop = min(max(stop, at + 1), at + SLICE_ROWS, n)
            yield batch.slice(at, stop - at)
            at = stop
