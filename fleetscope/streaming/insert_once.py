"""Insert once without a horizon (operator 8 in streams).

A message is named by its source position (partition, offset). What has been
seen of a partition is kept as a set of intervals of offsets: consecutive
offsets are one interval, however many they are. So that neither a call nor a
state row grows with the stream, a partition's offsets are cut into blocks of
``block`` consecutive numbers; the state of a block is its intervals -- one,
once the block is complete -- and a block's rows go through one call. A stream
of N messages leaves about N / block state rows, which are never dropped: a
message that is delivered again is recognised days later, and one that comes
late for the first time is not taken for a repeated one.

The state is a keyed state of Spark's state store, checkpointed with the
query. Rows go through the function as Arrow chunks, a chunk at a time.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Offsets of one state row.
BLOCK = 1 << 16

_STATE = T.StructType([T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType()))])


def unseen(offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of the first copy of every offset that lies in no interval (both ends included)."""
    _, first = np.unique(offsets, return_index=True)
    at = np.searchsorted(starts, offsets[first], side="right") - 1
    known = (at >= 0) & (offsets[first] <= ends[np.maximum(at, 0)]) if len(starts) else np.zeros(len(first), bool)
    return np.sort(first[~known])


def merged(starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals with ``offsets`` (not yet in them) added; neighbours become one."""
    starts, ends = np.concatenate([starts, offsets]), np.concatenate([ends, offsets])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    new = np.append(True, starts[1:] > ends[:-1] + 1)  # intervals do not overlap, so that ends ascend too
    return starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]


def _keep_new(offset_col: str, columns: list[str]):
    def keep(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # pandas warns inside Spark's Arrow reader when a chunk is empty
        warnings.filterwarnings("ignore", category=FutureWarning)
        if any(pd.isna(k) for k in key):  # no position: nothing to know it by
            yield from (c[columns] for c in chunks if len(c))
            return
        starts, ends = (np.array(x, np.int64) for x in (state.get if state.exists else ([], [])))
        for chunk in chunks:
            if not len(chunk):
                continue
            offsets = chunk[offset_col].to_numpy(dtype=np.int64)
            at = unseen(offsets, starts, ends)
            if len(at):
                starts, ends = merged(starts, ends, offsets[at])
                yield chunk.iloc[at][columns]
        state.update((starts.tolist(), ends.tolist()))

    return keep


def insert_once(rows: DataFrame, partition_col: str = "partition", offset_col: str = "offset", block: int = BLOCK) -> DataFrame:
    """Streaming ``rows``, each source position once, however late it is
    delivered again. Rows without a position are kept. Watermarks are to be
    set behind this step."""
    from fleetscope.session import ship_package
    ship_package(rows.sparkSession)  # the state function runs in Python workers
    blocks = rows.withColumn("_block", F.floor(F.col(offset_col) / block))
    return blocks.groupBy(partition_col, "_block").applyInPandasWithState(
        _keep_new(offset_col, rows.columns), rows.schema, _STATE, "append", GroupStateTimeout.NoTimeout)
