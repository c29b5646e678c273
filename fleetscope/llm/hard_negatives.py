"""Hard-negative mining by a GNAT-style multiway hyperplane tree.

Vectors are quantised to integers, so that scores (inner products) are exact. A vector x is lifted by one more component,
sqrt(M^2 - |x|^2) with M the greatest length, and a query a by a zero: the distance of a lifted query from a lifted row is
then |a|^2 + M^2 - 2 score, for rows of any length. A window of scores is an annulus of distances around the query.

The tree: a node has FANOUT split points, far from each other; a row belongs to the nearest one's cell (the cells' borders
are hyperplanes), and a cell is a node again until it is small enough for a leaf. Split points come from a sample of bounded
size; every row is put into a leaf, and each split point stores the range of its distances to the rows of each sibling's
cell, over all rows. A search goes down from the root: a sibling is left out if, for any split point, the range it stores for
that sibling does not meet the distances that the annulus allows. Leaves that are left are compared row by row, exactly.

Two searches: the best rows of the anchor's label (its positives; the window is open above), then the best rows of other
labels in the window of each positive. A window's lower end is first raised to the last score that counts in the sample,
which narrows the annulus and keeps what a leaf returns small; both only leave out rows that cannot be among the first.

Bounds: the driver sees the sample, the ranges (cells times FANOUT) and the leaves' sizes, all bounded by SAMPLE. A task has
one part of a leaf (LEAF_ROWS rows) and a part of the anchors (QUERY_ROWS); hot leaves have many parts. At most k rows for
each window leave a task.

Defined results: a row whose label or vector is null, or that has a null or non-finite component, takes no part; missing last
components count as zero, and so does an empty vector; quantised components stay within a bound by which scores fit a long
(2^26 for 64 components); a row without an id is no anchor, comes last among equal scores and is returned as null; repeated
rows and ids are rows of their own (a copy of an anchor can be its positive, and each copy of an anchor is mined); equal
scores go by id; extra columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetscope.llm.common import table, written
from fleetscope.session import ship_package

#: Split points of a node.
FANOUT = 16
#: Rows from which the split points are taken, and bytes of them.
SAMPLE, SAMPLE_BYTES = 4096, 16 << 20
#: Rows of a part of a leaf, and anchors of a task.
LEAF_ROWS, QUERY_ROWS = 4096, 8192
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these tenths of the positive's.
LOW, HIGH = 3, 9
#: Scores that one step of a task holds.
_CELLS = 1 << 21
_LEAST = -(1 << 62)


def quantised(vector: Column, dims: int, scale: int = 256) -> Column:
    """Each component times ``scale``, rounded down to an integer, within the bound of ``dims`` components."""
    most = float(min(1 << 30, isqrt((1 << 59) // max(dims, 1))))
    q = F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(most)), F.lit(-most))).cast("int"))
    return F.concat(q, F.array_repeat(F.lit(0), F.lit(dims) - F.size(q)))


def usable(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & label.isNotNull() & F.coalesce(finite, F.lit(False))


# -- the tree -----------------------------------------------------------------------------------------------------

def scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``x`` and ``y``."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(y).max(initial=0)))
    if most * most * x.shape[1] < 1 << 53:
        return np.rint(x.astype(np.float64) @ y.T.astype(np.float64)).astype(np.int64)
    return x.astype(np.int64) @ y.T.astype(np.int64)


@dataclass
class Node:
    points: np.ndarray  # the split points
    first: int  # number of its first cell; cells are numbered through the tree
    child: list  # of each cell the node below, None for a leaf
    low: np.ndarray = field(default=None)  # [j, i]: the range of point i's distances to cell j
    high: np.ndarray = field(default=None)


class Tree:
    """Split points from a sample of ``rows`` rows; ``most``: the square of the greatest length."""

    def __init__(self, sample: np.ndarray, rows: int, most: int, fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS):
        self.most, self.cells, self.nodes = float(most), 0, []
        self.slack = 1e-6 * max(1.0, self.most ** 0.5)
        self.root = self._node(sample, rows / max(1, len(sample)), fanout, leaf_rows)

    def _node(self, own: np.ndarray, weight: float, fanout: int, leaf_rows: int) -> Node:
        chosen = [0]
        near = self.between(own, own[:1])[:, 0]
        while len(chosen) < min(fanout, len(own)) and near.max() > self.slack:  # the point that is farthest from all so far
            chosen.append(int(near.argmax()))
            near = np.minimum(near, self.between(own, own[chosen[-1:]])[:, 0])
        node = Node(own[chosen], self.cells, [None] * len(chosen))
        k = len(chosen)
        node.low, node.high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        self.cells += k
        self.nodes.append(node)
        cell = self.between(own, node.points).argmin(axis=1)
        for j in range(k):
            part = own[cell == j]
            if k > 1 and len(part) * weight > leaf_rows and len(part) >= 4 * fanout:
                node.child[j] = self._node(part, weight, fanout, leaf_rows)
        return node

    def between(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Distances of lifted rows."""
        x, y = x.astype(np.float64), y.astype(np.float64)
        lift = lambda v: np.sqrt(np.maximum(0.0, self.most - (v * v).sum(axis=1)))
        return np.sqrt(np.maximum(0.0, 2 * (self.most - x @ y.T - lift(x)[:, None] * lift(y)[None, :])))

    def from_query(self, score: np.ndarray, square: np.ndarray) -> np.ndarray:
        """Distances of a lifted query of squared length ``square`` from rows of this score."""
        return np.sqrt(np.maximum(0.0, square + self.most - 2 * score.astype(np.float64)))

    def place(self, x: np.ndarray, seen: Callable[[Node, np.ndarray, np.ndarray], None] | None = None) -> np.ndarray:
        """The leaf of each row. ``seen`` gets each node, its rows' distances to the split points and their cells."""
        leaf, todo = np.zeros(len(x), np.int64), [(self.root, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            d = self.between(x[at], node.points)
            cell = d.argmin(axis=1)
            leaf[at] = node.first + cell
            if seen:
                seen(node, d, cell)
            todo += [(below, at[cell == j]) for j, below in enumerate(node.child) if below and (cell == j).any()]
        return leaf

    def search(self, query: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, leaf) pairs that cannot be left out for windows of scores ``low`` to ``high``, one query each."""
        square = (query.astype(np.float64) ** 2).sum(axis=1)
        outer, inner = self.from_query(low, square), self.from_query(high, square)
        found, todo = [], [(self.root, np.arange(len(query)))]
        while todo:
            node, at = todo.pop()
            for k in range(0, len(at), 4096):
                part = at[k:k + 4096]
                d = self.from_query(scores(query[part], node.points), square[part, None])
                least = np.maximum(d - outer[part, None], inner[part, None] - d) - self.slack
                most = d + outer[part, None] + self.slack
                alive = ((least[:, None, :] <= node.high) & (most[:, None, :] >= node.low)).all(axis=2)
                for j, below in enumerate(node.child):
                    left = part[alive[:, j]]
                    if below is not None and len(left):
                        todo.append((below, left))
                    elif len(left):
                        found.append((left, np.full(len(left), node.first + j)))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _matrix(column: pa.ListArray) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1), np.int32)


@dataclass
class Index:
    """The tree with its ranges, the sample, and the rows (row, id, label, q, leaf, part) as a written table."""
    tree: Tree
    sample: tuple[np.ndarray, np.ndarray, np.ndarray]  # row, label, q
    rows: DataFrame
    parts: dict[int, int]


def build(vectors: DataFrame, dims: int, fanout: int = FANOUT, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS) -> Index | None:
    """The index of ``vectors`` (row, id, label, q; written before); None where there is no row."""
    square = F.aggregate("q", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x.cast("long"))
    n, most = vectors.agg(F.count("*"), F.max(square)).first()
    if not n:
        return None
    size = max(2, min(sample, SAMPLE_BYTES // (8 * max(dims, 1))))
    picked = vectors.select("row", "label", "q").orderBy(F.xxhash64("row"), "row").limit(size).collect()
    rows = np.array([r.q for r in picked], np.int64).reshape(len(picked), -1)
    tree = Tree(rows, n, most, fanout, leaf_rows)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaf = tree.place(_matrix(b.column("q")))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], names=[*b.schema.names, "leaf"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields)
    placed = written(vectors.mapInArrow(place, f"{kinds}, leaf long"), "gnat-placed")

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = {x.first: np.full_like(x.low, np.inf) for x in tree.nodes}
        high = {x.first: np.full_like(x.high, -np.inf) for x in tree.nodes}

        def seen(node: Node, d: np.ndarray, cell: np.ndarray) -> None:
            np.minimum.at(low[node.first], cell, d)
            np.maximum.at(high[node.first], cell, d)

        for b in batches:
            if b.num_rows:
                tree.place(_matrix(b.column("q")), seen)
        for first, x in low.items():
            j, i = np.nonzero(np.isfinite(x))
            yield pa.RecordBatch.from_arrays([pa.array(first + j), pa.array(i), pa.array(x[j, i]), pa.array(high[first][j, i])],
                                             names=["cell", "point", "low", "high"])

    found = placed.select("q").mapInArrow(ranges, "cell long, point long, low double, high double").groupBy(
        "cell", "point").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    owner = {node.first + j: (node, j) for node in tree.nodes for j in range(len(node.child))}
    for r in found:
        node, j = owner[r.cell]
        node.low[j, r.point], node.high[j, r.point] = r.low, r.high
    parts = {r.leaf: -(-r["count"] // leaf_rows) for r in placed.groupBy("leaf").count().collect()}
    return Index(tree, (np.array([r.row for r in picked]), np.array([r.label for r in picked]), rows), placed, parts)


# -- searches -----------------------------------------------------------------------------------------------------

_WINDOW = pa.struct([("key", pa.int32()), ("low", pa.int64()), ("high", pa.int64())])


def _allowed(same: bool, own_label, own_row, label, row) -> np.ndarray:
    """[query, row]: may the row be returned?"""
    equal = own_label[:, None] == label[None, :]
    return equal & (own_row[:, None] != row[None, :]) if same else ~equal


def _last_of_first(s: np.ndarray, ok: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each line of ``s`` among those that are ``ok``; _LEAST where there are fewer."""
    s = np.where(ok, s, _LEAST)
    return np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] if s.shape[1] >= k else np.full(len(s), _LEAST)


def first_of(s: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, column) of the k best of each line among those that are ``ok``; of equal scores the first columns."""
    last = _last_of_first(s, ok, k)[:, None]
    above, tie = ok & (s > last), ok & (s == last)
    return np.nonzero(above | (tie & (np.cumsum(tie, axis=1) <= k - above.sum(axis=1, keepdims=True))))


def search(index: Index, queries: DataFrame, k: int, same: bool) -> DataFrame:
    """(row, key, id, score) of rows among which are the first ``k`` of every window. ``queries``: row, label, q, windows
    array<struct<key int, low long, high long>>; ``same``: rows of the query's label, else of other labels."""
    tree, (s_row, s_label, s_q), parts = index.tree, index.sample, index.parts

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, _CELLS // max(1, len(s_row)))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                q, lists = _matrix(b.column("q")), b.column("windows")
                of = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                w = lists.flatten()
                key, low, high = (w.field(x).to_numpy(zero_copy_only=False) for x in ("key", "low", "high"))
                s = scores(q, s_q)
                ok = _allowed(same, *(b.column(x).to_numpy(zero_copy_only=False) for x in ("label", "row")), s_label, s_row)
                low = low.copy()
                for i in range(0, len(of), step):
                    part = of[i:i + step]
                    inside = ok[part] & (s[part] >= low[i:i + step, None]) & (s[part] <= high[i:i + step, None])
                    low[i:i + step] = np.maximum(low[i:i + step], _last_of_first(s[part], inside, k))
                window, leaf = tree.search(q[of], low, high)
                order = np.lexsort((key[window], leaf, of[window]))
                window, leaf = window[order], leaf[order]
                if not len(window):
                    continue
                new = np.append(True, (of[window][1:] != of[window][:-1]) | (leaf[1:] != leaf[:-1]))
                first = np.flatnonzero(new)
                take = pa.array(of[window][first])
                inner = pa.StructArray.from_arrays([pa.array(key[window], pa.int32()), pa.array(low[window]), pa.array(high[window])],
                                                   fields=list(_WINDOW))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf[first]), pa.array([parts.get(x, 0) for x in leaf[first].tolist()], pa.int32()),
                     *(b.column(x).take(take) for x in ("row", "label", "q")),
                     pa.ListArray.from_arrays(pa.array(np.append(first, len(window)), pa.int32()), inner)],
                    names=["leaf", "parts", "row", "label", "q", "windows"])

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        side = group.column("side").to_numpy()
        rows, asked = group.filter(pa.array(side == 0)).combine_chunks(), group.filter(pa.array(side == 1)).combine_chunks()
        out = [[], [], [], []]
        if rows.num_rows and asked.num_rows:
            # by id, without an id last
            none = rows.column("id").is_null().to_numpy()
            ids = rows.column("id").fill_null(0).to_numpy()
            order = np.lexsort((ids, none))
            none, ids = none[order], ids[order]
            x, y = (_matrix(t.column("q").combine_chunks()) for t in (rows, asked))
            x = x[order]
            label, row = (rows.column(c).to_numpy()[order] for c in ("label", "row"))
            lists = asked.column("windows").combine_chunks()
            of = np.repeat(np.arange(asked.num_rows), lists.value_lengths().to_numpy())
            w = lists.flatten()
            key, low, high = (w.field(c).to_numpy() for c in ("key", "low", "high"))
            own_label, own_row = asked.column("label").to_numpy(), asked.column("row").to_numpy()
            step = max(1, _CELLS // len(x))
            for i in range(0, len(of), step):
                part = of[i:i + step]
                lines, line = np.unique(part, return_inverse=True)
                s = scores(y[lines], x)[line]
                ok = _allowed(same, own_label[part], own_row[part], label, row)
                ok &= (s >= low[i:i + step, None]) & (s <= high[i:i + step, None])
                at, col = first_of(s, ok, k)
                for got, value in zip(out, (own_row[part][at], key[i:i + step][at],
                                            pa.array(ids[col], mask=none[col]), s[at, col])):
                    got.append(value if isinstance(value, pa.Array) else pa.array(value))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.chunked_array([v.cast(kind) for v in got], kind) for got, kind in zip(out, kinds)],
                        names=["row", "key", "id", "score"])

    # a part of the anchors to each task of a part of a leaf
    n = max(1, -(-queries.count() // QUERY_ROWS))
    asked = queries.select("row", "label", "q", "windows").mapInArrow(
        visits, "leaf long, parts int, row long, label long, q array<int>, "
                "windows array<struct<key: int, low: bigint, high: bigint>>")
    of_rows = F.pmod(F.xxhash64("row", F.lit("leaf")), F.lit(n)).cast("int")
    asked = asked.filter("parts > 0").select(
        "leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), of_rows.alias("chunk"), F.lit(1).alias("side"),
        "row", F.lit(None).cast("long").alias("id"), "label", "q", "windows")
    of_leaf = F.array(*(F.lit(parts.get(i, 1)) for i in range(tree.cells)))[F.col("leaf").cast("int")]
    leaves = index.rows.select(
        "leaf", F.pmod(F.xxhash64("row", F.lit("part")), of_leaf).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("chunk"), F.lit(0).alias("side"), "row", "id", "label", "q",
        F.lit(None).cast("array<struct<key: int, low: bigint, high: bigint>>").alias("windows"))
    return leaves.unionByName(asked).groupBy("leaf", "part", "chunk").applyInArrow(
        compare, "row long, key int, id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row", "key").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
         positives: int = POSITIVES, negatives: int = NEGATIVES, fanout: int = FANOUT, sample: int = SAMPLE,
         leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows where ``anchor`` is true."""
    spark = vectors.sparkSession
    ship_package(spark)
    label = F.col("label") if label is None else label
    kept = vectors.filter(usable(F.col(vector_col), label))
    dims = max(1, kept.agg(F.max(F.size(vector_col))).first()[0] or 0)
    rows = written(kept.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                               label.cast("long").alias("label"), quantised(F.col(vector_col), dims).alias("q"),
                               F.coalesce(anchor, F.lit(False)).alias("anchor")), "gnat-vectors")
    index = build(rows.drop("anchor"), dims, fanout, sample, leaf_rows)
    if index is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
                                         "negative_score long")
    anchors = rows.filter("anchor").select("row", "id", "label", "q")
    window = lambda key, low, high: F.struct(key.cast("int").alias("key"), low.cast("long").alias("low"),
                                             high.cast("long").alias("high"))
    all_scores = F.array(window(F.lit(0), F.lit(_LEAST), F.lit(1 << 60)))
    best = _ranked(search(index, anchors.withColumn("windows", all_scores), positives, True), positives)
    best = written(best.select("row", F.col("rank").alias("key"), F.col("id").alias("positive_id"),
                               F.col("score").alias("positive_score")), "gnat-positives")
    # 3 p <= 10 n <= 9 p, so that a positive of a negative score has none
    p = F.col("positive_score")
    low, high = F.ceil(F.expr(f"{LOW} * cast(positive_score as decimal(38,0)) / 10")), F.floor(
        F.expr(f"{HIGH} * cast(positive_score as decimal(38,0)) / 10"))
    windows = best.filter(p >= 0).groupBy("row").agg(F.collect_list(window(F.col("key"), low, high)).alias("windows"))
    asked = written(anchors.join(windows, "row"), "gnat-windows")
    found = _ranked(search(index, asked, negatives, False), negatives).select(
        "row", "key", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select("row", F.col("id").alias("anchor_id"))
    return found.join(best, ["row", "key"]).join(ids, "row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec = F.col("vec_id")
    label = F.when(vec % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(table(spark, sf_dir, "embeddings"), vec % 100 == 0, label=label)


ORACLE_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::double)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS bigint) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(rank AS integer) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
      FROM positive JOIN scored USING (anchor_id)
      WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
WHERE rank <= 10
"""
