"""Interval sets of seen offsets: the helper functions and a stream over several runs."""
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetscope.session import new_subdir
from fleetscope.streaming.insert_once import insert_once, merged, unseen
from fleetscope.streaming.jobs import run_to_end


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), max_size=30), max_size=8))
def test_intervals_hold_what_was_seen(batches):
    starts = ends = np.zeros(0, np.int64)
    seen: set[int] = set()
    for batch in batches:
        offsets = np.array(batch, np.int64)
        at = unseen(offsets, starts, ends)
        assert sorted(offsets[at].tolist()) == sorted(set(batch) - seen) and (np.diff(at) > 0).all()
        if len(at):
            starts, ends = merged(starts, ends, offsets[at])
        seen |= set(batch)
        assert {x for a, b in zip(starts.tolist(), ends.tolist()) for x in range(a, b + 1)} == seen
        assert (starts[1:] > ends[:-1] + 1).all()  # apart by one number at least


def test_redelivery_after_many_batches_and_restarts(spark):
    """Out-of-order offsets, copies in one batch, in later batches and after a restart; rows without a position."""
    root = new_subdir(spark, "t-once")
    schema = "partition int, offset long, body string"
    runs = [[(p, o, f"{p}-{o}") for p in (0, 1) for o in range(0, 3000, 2)] + [(0, 4, "0-4")] * 3 + [(None, None, "x"), (0, None, "y")],
            [(p, o, f"{p}-{o}") for p in (0, 1) for o in range(2999, -1, -1)],  # the odd ones are new
            [(0, o, f"0-{o}") for o in range(3000, 3100)] + [(0, 0, "0-0"), (1, 2999, "1-2999"), (2, 0, "2-0"), (None, None, "x")]]
    state = []
    for rows in runs:
        spark.createDataFrame(rows, schema).repartition(4).write.mode("append").json(f"{root}/in")
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", "2").json(f"{root}/in")
        q = (insert_once(src, block=1000).writeStream.format("parquet").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/_ck").trigger(availableNow=True).start())
        run_to_end(q)
        state.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = sorted((r.body, r.offset) for r in spark.read.parquet(f"{root}/out").collect() if r.offset is not None)
    assert got == sorted({(b, o) for rows in runs for _, o, b in rows if o is not None})
    assert spark.read.parquet(f"{root}/out").where(F.col("offset").isNull()).count() == 3
    assert state[-1] <= 8 + 2  # a row for each thousand offsets of a partition, not for each message
