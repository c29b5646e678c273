"""SimHash near-duplicates by a binary trie self-join.

A text is lower-cased (A-Z), cut into words at ASCII white space and into shingles of ``shingle`` words, repeats
included; a fingerprint bit is 1 if it is set in over half of the shingles' XXH64 values. Fingerprints that differ in at
most ``budget`` bits are linked; the links' components are the groups.

The join works on distinct fingerprints. Its bits are cut into budget + 2 blocks; two fingerprints within the budget
agree in at least two blocks, so that for every pair of blocks the fingerprints are dealt to tasks by the bits of both
(``_dealt``). In a task they form a binary trie, whose nodes are ranges of the sorted values: node pairs are walked
together bit by bit, their differing bits are summed, and a pair beyond the budget is pruned (``close_pairs``). A task of more
than ``task_rows`` fingerprints is not walked whole: its trie is cut at the next ``_STEP`` bits into nodes, and every pair of
nodes that is within the budget so far becomes a task of its own, again and again until all tasks are small (``_split``).
From the links of a task only those of its groups' stars are returned, so that the edges never outnumber the rows.

Defined results: a null, empty or blank text has fingerprint zero and is linked like any other; a text of fewer words than
a shingle is one shingle; equal fingerprints are one group; a group's id is its least non-null doc_id (null if it has
none); repeated rows and ids are each returned; extra columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm.common import slices, table, written
from fleetscope.llm.components import components
from fleetscope.session import ship_package

SHINGLE = 3
BUDGET = 3
SEED = 42
#: Fingerprints of one walk; larger tasks are split at the next bits of the trie.
TASK_ROWS = 2048
#: Bits of the trie by which a large task is split at a time.
_STEP = 8
#: Node pairs that are walked at once; more are walked in parts.
_FRONT = 1 << 20
#: Shingles whose bits are summed at once.
_RUN = 1 << 16
#: Columns that keep_one adds for its join.
_ID, _HASH = "__simhash_id", "__simhash_hash"


# -- fingerprints -------------------------------------------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    import xxhash

    own = text.encode().lower().split() if text else []
    if not own:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(own) <= shingle:
        return digest(b" ".join(own), SEED)
    whole = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(own) - shingle + 1
    total = np.zeros(64, np.int64)
    for at in range(0, n, _RUN):
        stop = min(at + _RUN, n)
        h = np.fromiter((digest(whole[a:b], SEED) for a, b in zip(
            starts[at:stop].tolist(), ends[at + shingle - 1:stop + shingle - 1].tolist())), np.uint64, stop - at)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, text_hash, fp) of every row; fp holds the 64 bits as a signed long, text_hash tells rows of one id apart."""
    ship_package(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
                         F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            fps = np.fromiter((fingerprint(t, shingle) for t in part.column(2).to_pylist()), np.uint64, part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fps.view(np.int64))],
                                             names=["id", "text_hash", "fp"])

    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, text_hash long, fp long").withColumnRenamed("id", id_col)


# -- the walk through one task's trie -----------------------------------------------------------------------------

def close_pairs(values: np.ndarray, task: np.ndarray, side: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of values within ``budget`` bits in one task. Rows are sorted by task, side and value; side 0
    is compared with itself, side 1 with side 2."""
    n = len(values)
    new = np.ones(n, bool)
    new[1:] = (task[1:] != task[:-1]) | (side[1:] != side[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], n)
    kind, of = side[lo], task[lo]
    own = (kind == 0) & (hi - lo > 1)
    first = np.flatnonzero((kind[:-1] == 1) & (kind[1:] == 2) & (of[:-1] == of[1:])) if len(lo) > 1 else np.zeros(0, int)
    front = tuple(np.concatenate(x) for x in ((lo[own], lo[first]), (hi[own], hi[first]), (lo[own], lo[first + 1]),
                                              (hi[own], hi[first + 1])))
    stack = [(63, *front, np.zeros(len(front[0]), np.int64))]
    ones: dict[int, np.ndarray] = {}
    while stack:
        bit, a0, a1, b0, b1, d = stack.pop()
        while len(a0):
            if len(a0) > _FRONT:
                half = len(a0) // 2
                stack.append((bit, *(x[half:] for x in (a0, a1, b0, b1, d))))
                a0, a1, b0, b1, d = (x[:half] for x in (a0, a1, b0, b1, d))
            # two leaves: all bits at once
            leaf = (a1 - a0 == 1) & (b1 - b0 == 1)
            if leaf.any():
                i, j = a0[leaf], b0[leaf]
                near = np.bitwise_count(values[i] ^ values[j]) <= budget
                near &= i != j
                yield i[near], j[near]
                a0, a1, b0, b1, d = (x[~leaf] for x in (a0, a1, b0, b1, d))
            if not len(a0) or bit < 0:  # below the last bit only equal values are left
                break
            if bit not in ones:
                ones[bit] = np.concatenate([[0], np.cumsum((values >> np.uint64(bit) & np.uint64(1)).astype(np.int64))])
            c = ones[bit]
            am, bm = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0])
            same = a0 == b0
            nodes = ((a0, am, b0, bm, d, None), (am, a1, bm, b1, d, None), (a0, am, bm, b1, d + 1, None),
                     (am, a1, b0, bm, d + 1, ~same))  # of a node with itself, one order of the children is enough
            kept = []
            for x0, x1, y0, y1, e, also in nodes:
                keep = (x1 > x0) & (y1 > y0) & (e <= budget) & ~((x0 == y0) & (x1 - x0 == 1))
                if also is not None:
                    keep &= also
                kept.append((x0[keep], x1[keep], y0[keep], y1[keep], e[keep]))
            a0, a1, b0, b1, d = (np.concatenate(x) for x in zip(*kept))
            bit -= 1


def stars(n: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n rows the least row that its links reach."""
    root = np.arange(n)
    if not links:
        return root
    i, j = (np.concatenate(x) for x in zip(*links))
    while len(i):
        a, b = root[i], root[j]
        low = np.minimum(a, b)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while not np.array_equal(up := root[root], root):
            root = up
        open_ = root[i] != root[j]
        i, j = i[open_], j[open_]
    return root


def _walk(budget: int):
    """Rows (task, side, value, fp) sorted by task, each task in one partition -> edges (a, b) between fingerprints."""

    def edges(rows: list[pa.Table | pa.RecordBatch]) -> pa.RecordBatch:
        task, side, value, fp = (np.concatenate([r.column(k).to_numpy(zero_copy_only=False) for r in rows]) for k in range(4))
        value = value.view(np.uint64)
        order = np.lexsort((value, side, task))
        task, side, value, fp = task[order], side[order], value[order], fp[order]
        root = stars(len(task), list(close_pairs(value, task, side, budget)))
        at = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array(fp[root[at]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the last task, which the next batch may go on with
        for batch in batches:
            if not batch.num_rows:
                continue
            task = batch.column(0).to_numpy(zero_copy_only=False)
            start = int(np.searchsorted(task, task[-1]))
            if start == 0 and (not held or held[-1].column(0)[-1].as_py() == task[-1]):
                held.append(batch)
                continue
            yield edges([*held, batch.slice(0, start)])
            held = [batch.slice(start)]
        if held:
            yield edges(held)

    return run


# -- dealing out --------------------------------------------------------------------------------------------------

def _field(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))


def _dealt(fps: DataFrame, budget: int) -> DataFrame:
    """(task, side, value, fp): for every pair of the budget + 2 blocks, the task of the bits of both, and the
    fingerprint with those bits first."""
    n = budget + 2
    cuts = [64 * k // n for k in range(n + 1)]
    blocks = [(cuts[k], cuts[k + 1] - cuts[k]) for k in range(n)]
    rows = []
    for number, chosen in enumerate(combinations(range(n), 2)):
        order = [*chosen, *(k for k in range(n) if k not in chosen)]
        value, left = F.lit(0).cast("long"), 64
        for k in order:
            left -= blocks[k][1]
            value = value.bitwiseOR(F.shiftleft(_field(F.col("fp"), *blocks[k]), left))
        keys = [_field(F.col("fp"), *blocks[k]) for k in chosen]
        rows.append(F.struct(F.xxhash64(F.lit(number), *keys).alias("task"), value.alias("value")))
    return fps.select("fp", F.explode(F.array(*rows)).alias("r")).select(
        F.col("r.task").alias("task"), F.lit(0).alias("side"), F.col("r.value").alias("value"), "fp")


def _split(rows: DataFrame, depth: int, budget: int) -> DataFrame:
    """Tasks cut at the ``_STEP`` bits below ``depth``: one task for each pair of nodes within the budget so far."""
    node = _field(F.col("value"), 64 - depth - _STEP, _STEP)
    rows = written(rows.withColumn("node", node), "simhash-large")
    nodes = rows.select("task", "side", "used", "node").distinct()
    left = nodes.filter("side < 2").select("task", "side", "used", F.col("node").alias("a"))
    right = nodes.filter("side != 1").select("task", F.col("side").alias("other"), F.col("node").alias("b"))
    used = F.col("used") + F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = left.join(right, "task").filter(
        ((F.col("side") == 0) & (F.col("other") == 0) & (F.col("a") <= F.col("b"))) |
        ((F.col("side") == 1) & (F.col("other") == 2))).filter(used <= budget)
    pairs = written(pairs.select("task", "side", "a", "b", used.alias("next_used"),
                                 F.xxhash64("task", "side", "a", "b").alias("next")), "simhash-pairs")
    of_a = rows.filter("side < 2").join(pairs.withColumnRenamed("side", "pair_side"),
                                        ["task"]).filter("node = a and side = pair_side")
    of_b = rows.filter("side != 1").join(pairs.withColumnRenamed("side", "pair_side"),
                                         ["task"]).filter("node = b and side = 2 * pair_side and not (pair_side = 0 and a = b)")
    own = F.when((F.col("pair_side") == 0) & (F.col("a") == F.col("b")), F.lit(0))
    return of_a.select(F.col("next").alias("task"), own.otherwise(1).alias("side"), "value", "fp",
                       F.col("next_used").alias("used")).unionByName(
        of_b.select(F.col("next").alias("task"), F.lit(2).alias("side"), "value", "fp", F.col("next_used").alias("used")))


def links(fps: DataFrame, budget: int = BUDGET, task_rows: int = TASK_ROWS) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints of ``fps`` (column fp) that join all those within ``budget`` bits."""
    rows = _dealt(fps, budget).withColumn("used", F.lit(0))
    # a block has at least 64 // (budget + 2) bits; what stands before this depth is equal in every task
    depth = 2 * (64 // (budget + 2)) // _STEP * _STEP
    found = None
    while True:
        large = written(rows.groupBy("task").count().filter(F.col("count") > task_rows).select("task"), "simhash-tasks")
        more = depth < 64 and not large.isEmpty()
        ready = rows.join(large, "task", "left_anti") if more else rows
        edges = (ready.select("task", "side", "value", "fp").repartition("task").sortWithinPartitions("task")
                 .mapInArrow(_walk(budget), "a long, b long"))
        found = edges if found is None else found.unionByName(edges)
        if not more:
            return found.distinct()
        rows = written(_split(rows.join(large, "task", "left_semi"), depth, budget), "simhash-split")
        depth += _STEP


def groups(prints: DataFrame, id_col: str = "doc_id", budget: int = BUDGET, task_rows: int = TASK_ROWS) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of ``prints`` (id, fp): the least fingerprint, as a signed
    number, and the least id of its component."""
    ship_package(prints.sparkSession)
    least = written(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-distinct")
    linked = written(components(links(least.select("fp"), budget, task_rows), "a", "b"), "simhash-roots")
    rooted = written(least.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
                     .select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    ids = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-ids")
    return written(rooted.join(ids, "root").select("fp", "root", "component_id"), "simhash-groups")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    budget: int = BUDGET, task_rows: int = TASK_ROWS) -> DataFrame:
    """(id, text_hash, fp, root, component_id) of every row of ``docs``."""
    prints = written(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    return prints.join(groups(prints, id_col, budget, task_rows), "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             budget: int = BUDGET) -> DataFrame:
    """One row of each group, with all its columns: the row of the least id (null last), of several rows of that id the
    one whose text has the least hash, and of rows equal in both any one."""
    names = docs.columns
    found = near_duplicates(docs, id_col, text_col, shingle, budget)
    best = found.groupBy("root").agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                                                    F.col("text_hash").alias("hash"))).alias("k"))
    best = written(best.select(F.coalesce(F.col("k.id").cast("string"), F.lit("")).alias(_ID),
                               F.col("k.hash").alias(_HASH)).distinct(), "simhash-best")
    rows = docs.withColumns({_ID: F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                             _HASH: F.xxhash64(F.col(text_col).cast("string"))})
    return rows.join(best, [_ID, _HASH], "left_semi").dropDuplicates([_ID, _HASH]).select(*names)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
