"""Conversation prefix trie in balanced parentheses.

A turn is named by 16 bytes of the SHA-256 of its role and text, a conversation by the names of its turns in a row: its key.
Keys are sorted over the cluster (range partitions by key and id, so that many copies of one conversation are cut too), and a
*shard* is a run of sorted keys of bounded size. In a shard the keys' common prefixes give the trie's nodes in preorder and
its balanced parentheses (``Parentheses``): an opening one for each node when it is entered and a closing one when it is left.

- ``findclose`` ends a node's subtree: the excess (open minus closed) is kept with its minimum and maximum for blocks of
  BLOCK parentheses and for pairs of blocks, pairs of pairs and so on; the close is searched in the node's own block, then up
  and down this range min-max tree, then in one block;
- the rank of leaf pairs "()" up to a place counts the leaves of a subtree by one difference;
- cumulative arrays over the nodes in preorder give a subtree's savings by one difference;
- the keys of a subtree lie together, so that its least id is a range minimum (a sparse table).

Only the first and the last key of a shard can share nodes with other shards. The nodes on these two paths, the shard's
*spines*, are not yet final: what the shard knows of them (members, own children, leaves and savings below that are not on a
spine) is handed up as two rows, and the spines of all shards are sorted, cut into shards and merged by the same code, until
one shard holds them all. Nodes right below a spine learn their parent's id by a join on (shard, parent).

The hash of the ids that end at a node is made in the shard; where copies of one conversation lie in several shards, each
shard's ids are joined to text there, and these pieces, in order, go through one hash (the hash is sequential by definition,
its input is some bytes an id).

Bounds: a shard holds SHARD nodes at most, or 64 conversations. A conversation is one row while it is rebuilt: 36 bytes a
turn, whatever its texts. Nothing but counts goes through the driver.

Defined results: rows without a conv_id belong to no conversation; of turns with equal numbers (null comes first) the order
is that of their SHA-256, and repeated rows are turns of their own; an empty text has no words; extra columns are not read; an
empty table gives an empty table (no root).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm.common import table, written
from fleetscope.session import ship_package

#: Bytes of a turn's name.
NAME = 16
#: Nodes and rows of a shard.
SHARD = 1 << 20
#: Parentheses of a block of the range min-max tree.
BLOCK = 64
#: Ids of a conversation that are one piece of text.
_PIECE = 1 << 10
#: A shard has so many conversations at least, so that spines get fewer from level to level.
_FEWEST = 64
_WORD = r"[^\x20\x09-\x0D]+"
_EMPTY = hashlib.sha256(b"").hexdigest()


# -- conversations ------------------------------------------------------------------------------------------------

def shared_turns(conv_id: Column) -> Column:
    """How many turns conversation ``conv_id`` takes over from the first of its twenty."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 4).cast("int")


def rebuilt(conversations: DataFrame, most: int = 3) -> DataFrame:
    """(conv_id, key, words) of every conversation: the names of its turns in a row and the words of each turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * NAME)
    turn = F.struct(F.col("turn"), name.alias("name"), F.regexp_count(text, F.lit(_WORD)).alias("words"))
    own = conversations.filter(F.col("conv_id").isNotNull()).select("conv_id", turn.alias("t"))
    own = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts")).select(
        "conv_id", F.transform("ts", lambda t: F.struct(t["name"].alias("name"), t["words"].alias("words"))).alias("ts"))
    own = written(own, "trie-conversations")
    first = own.filter(F.col("conv_id") % 20 == 0).select(F.col("conv_id").alias("of"), F.slice("ts", 1, most).alias("head"))
    h = shared_turns(F.col("conv_id"))
    joined = own.join(first, F.col("conv_id") - F.col("conv_id") % 20 == F.col("of"), "left")
    none = F.expr("cast(array() as array<struct<name: string, words: int>>)")
    rest = F.when(F.size("ts") > h, F.slice("ts", h + 1, F.greatest(F.size("ts") - h, F.lit(1)))).otherwise(none)
    head = F.when(F.col("of").isNotNull() & (h > 0), F.slice("head", 1, F.greatest(h, F.lit(1)))).otherwise(none)
    ts = F.concat(head, rest)
    return joined.select("conv_id", F.unhex(F.array_join(ts["name"], "")).alias("key"), ts["words"].alias("words"))


# -- balanced parentheses -----------------------------------------------------------------------------------------

class Parentheses:
    """A trie's shape: ``bits`` has a 1 for each opening and a 0 for each closing parenthesis."""

    def __init__(self, bits: np.ndarray, block: int = BLOCK):
        self.bits, self.block = bits, block
        self.opens = np.flatnonzero(bits)
        self.excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        n = max(1, -(-len(bits) // block))
        padded = np.concatenate([self.excess, np.full(n * block - len(bits), self.excess[-1] if len(bits) else 0)])
        # minima and maxima of the excess: of blocks, of pairs of blocks, and so on up to one range
        self.low, self.high = [padded.reshape(n, block).min(axis=1)], [padded.reshape(n, block).max(axis=1)]
        while len(self.low[-1]) > 1:
            pair = np.arange(0, len(self.low[-1]), 2)
            self.low.append(np.minimum.reduceat(self.low[-1], pair))
            self.high.append(np.maximum.reduceat(self.high[-1], pair))

    def _scan(self, at: np.ndarray, want: np.ndarray, stop: np.ndarray, out: np.ndarray, who: np.ndarray) -> np.ndarray:
        """Looks for the excess ``want`` from ``at`` on, before ``stop``; returns the places in ``who`` that found none."""
        left = np.arange(len(at))
        at = at.copy()
        while len(left):
            left = left[at[left] < stop[left]]
            hit = self.excess[at[left]] == want[left]
            out[who[left[hit]]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
        return np.flatnonzero(out[who] < 0)

    def findclose(self, p: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one: the first place after it with an excess that is less by one than at it."""
        out = np.full(len(p), -1)
        want, block = self.excess[p] - 1, p // self.block
        end = np.minimum((block + 1) * self.block, len(self.bits))
        who = self._scan(p + 1, want, end, out, np.arange(len(p)))
        # up, to the first range further right that goes down to the excess wanted
        node, want, level = block[who], want[who], np.zeros(len(who), np.int64)
        climbing = np.arange(len(who))
        for k in range(len(self.low)):
            right = node[climbing] + 1
            ok = (node[climbing] % 2 == 0) & (right < len(self.low[k]))
            # the excess moves by single steps: a range reaches all between its minimum and maximum
            ok[ok] = (self.low[k][right[ok]] <= want[climbing][ok]) & (want[climbing][ok] <= self.high[k][right[ok]])
            node[climbing[ok]], level[climbing[ok]] = right[ok], k
            climbing = climbing[~ok]
            node[climbing] //= 2
        # down, to the first block in it
        for k in range(len(self.low) - 1, 0, -1):
            at = np.flatnonzero(level == k)
            node[at] *= 2
            node[at] += self.low[k - 1][node[at]] > want[at]
            level[at] = k - 1
        self._scan(node * self.block, want, np.minimum((node + 1) * self.block, len(self.bits)), out, who)
        return out

    def leaf_rank(self, counts: np.ndarray) -> np.ndarray:
        """Leaf pairs before each place; ``counts``: of each node in preorder, whether its pair counts."""
        pair = np.zeros(len(self.bits) + 1, np.int64)
        at = self.opens
        leaf = self.bits[np.minimum(at + 1, len(self.bits) - 1)] == 0
        pair[at + 1] = leaf & counts
        return np.cumsum(pair)


def _least_in(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least of values[lo:hi] for each pair, by a sparse table."""
    tables = [values]
    while 2 ** len(tables) <= len(values):
        half = 2 ** (len(tables) - 1)
        tables.append(np.minimum(tables[-1][:-half], tables[-1][half:]))
    level = np.floor(np.log2(np.maximum(hi - lo, 1))).astype(np.int64)
    out = np.empty(len(lo), values.dtype)
    for k, t in enumerate(tables):
        at = level == k
        out[at] = np.minimum(t[lo[at]], t[hi[at] - 2 ** k])
    return out


# -- one shard ----------------------------------------------------------------------------------------------------

class Shard:
    """The trie of sorted keys. Each key brings, for every node on its path (root first), numbers of members, children,
    leaves and savings that are known from below, and its last nodes' words."""

    def __init__(self, keys: list[bytes], least: np.ndarray, words: np.ndarray, below: dict[str, np.ndarray] | None = None):
        n = len(keys)
        self.keys, self.turns = keys, np.array([len(k) // NAME for k in keys])
        path = self.turns + 1
        start = np.concatenate([[0], np.cumsum(path)])
        row = np.repeat(np.arange(n), path)
        depth = np.arange(start[-1]) - start[row]
        common = self._common(n)
        # a key's nodes deeper than what it shares with the key before are new; numbered in preorder
        new = depth > common[row]
        number = np.cumsum(new) - 1
        order = np.lexsort((row, depth))
        self.node_of = np.empty(len(row), np.int64)
        self.node_of[order] = np.maximum.accumulate(np.where(new[order], np.arange(len(order)), 0))
        self.node_of[order] = number[order[self.node_of[order]]]
        self.row, self.depth, self.first = row, depth[new], row[new]
        self.start, self.path_depth = start, depth
        m = len(self.depth)
        if below is None:
            self.members = np.zeros(m, np.int64)
            np.add.at(self.members, self.node_of, 1)
            self.kids = self.leaves = self.saved = np.zeros(m, np.int64)
        else:
            self.members, self.kids, self.leaves, self.saved = (self._summed(below[c], m) for c in (
                "members", "kids", "leaves", "saved"))
        node_words = np.zeros(m, np.int64)
        turn = depth > 0
        node_words[self.node_of[turn]] = words
        self.words = node_words
        self.parent = np.where(self.depth > 0, self.node_of[start[self.first] + np.maximum(self.depth - 1, 0)], -1)
        # parentheses: before a key's new nodes open, the nodes of the key before that it does not share close
        opened, closed = self.turns - common, np.concatenate([self.turns[:-1] - common[1:], [self.turns[-1] + 1]])
        runs = np.stack([opened, closed], axis=1).ravel()
        self.shape = Parentheses(np.repeat(np.tile(np.array([1, 0], np.int8), n), runs))
        self.close = self.shape.findclose(self.shape.opens)
        # preorder numbers and rows of a subtree lie between its parentheses
        rank = np.concatenate([[0], np.cumsum(self.shape.bits, dtype=np.int64)])
        self.after = rank[self.close]
        last = np.where(self.after < m, self.first[np.minimum(self.after, m - 1)], n)
        # the keys of a subtree: up to that which opens the next node, or that which closes this one
        self.until = np.maximum(last, self.first + 1)
        if below is None:
            self.least = _least_in(least, self.first, self.until)
        else:
            self.least = np.full(m, np.iinfo(np.int64).max)
            np.minimum.at(self.least, self.node_of, below["low"])

    def _summed(self, values: np.ndarray, m: int) -> np.ndarray:
        out = np.zeros(m, np.int64)
        np.add.at(out, self.node_of, values)
        return out

    def _common(self, n: int) -> np.ndarray:
        """Turns that each key shares with the one before; -1 for the first."""
        names = np.frombuffer(b"".join(self.keys), np.uint64).reshape(-1, NAME // 8)
        start = np.concatenate([[0], np.cumsum(self.turns)])
        common = np.full(n, -1)
        if n > 1:
            most = np.minimum(self.turns[1:], self.turns[:-1])
            row = np.repeat(np.arange(1, n), most)
            place = np.arange(len(row)) - np.repeat(np.cumsum(most) - most, most)
            differs = (names[start[row] + place] != names[start[row - 1] + place]).any(axis=1)
            common[1:] = most
            np.minimum.at(common, row[differs], place[differs])
        return common

    def path(self, key: int) -> np.ndarray:
        return self.node_of[self.start[key]:self.start[key + 1]]

    def totals(self, open_: np.ndarray) -> tuple[np.ndarray, ...]:
        """(children, leaves, savings) of every node; what nodes that are ``open_`` add themselves is left out."""
        m = len(self.depth)
        own = np.zeros(m, np.int64)
        np.add.at(own, self.parent[1:], ~open_[1:])
        children = self.kids + own
        rank = self.shape.leaf_rank((self.kids == 0) & ~open_)
        leaves = self.leaves + rank[self.close] - rank[self.shape.opens]
        worth = np.concatenate([[0], np.cumsum(np.where(open_, 0, (self.members - 1) * self.words))])
        saved = self.saved + worth[self.after] - worth[np.arange(m)]
        return children, leaves, saved


def _place(prefix: bytes) -> bytes:
    return hashlib.sha256(prefix).digest()


_NODE = pa.schema([("kind", pa.int8()), ("shard", pa.int64()), ("place", pa.binary()), ("conv_id", pa.int64()),
                   ("depth", pa.int64()), ("parent", pa.int64()), ("parent_place", pa.binary()), ("n_convs", pa.int64()),
                   ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()),
                   ("key", pa.binary()), ("words", pa.list_(pa.int64())), ("places", pa.list_(pa.binary())),
                   ("members", pa.list_(pa.int64())), ("kids", pa.list_(pa.int64())), ("leaves", pa.list_(pa.int64())),
                   ("saved", pa.list_(pa.int64())), ("low", pa.list_(pa.int64())), ("ids", pa.string())])
_NODE_SQL = ("kind byte, shard long, place binary, conv_id long, depth long, parent long, parent_place binary, n_convs long, "
             "n_children long, n_leaves long, saved_tokens long, ends string, key binary, words array<long>, "
             "places array<binary>, members array<long>, kids array<long>, leaves array<long>, saved array<long>, low array<long>, ids string")
#: Kinds of rows: a final node, a spine, a piece of the ids that end at a spine's node.
_FINAL, _SPINE, _IDS = 0, 1, 2


def _rows(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _NODE], schema=_NODE)


def _ended(shard: Shard, ids: np.ndarray, spine: np.ndarray):
    """Of every node the hash of the ids that end there, and (node, first id, text) pieces of nodes on a spine."""
    ends = np.full(len(shard.depth), _EMPTY, object)
    pieces = []
    node = shard.node_of[shard.start[1:] - 1]
    starts = np.append(np.flatnonzero(np.append(True, node[1:] != node[:-1])), len(node))
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if spine[node[lo]]:
            pieces += [(node[lo], ids[k], ",".join(map(str, ids[k:min(k + _PIECE, hi)].tolist()))) for k in range(lo, hi, _PIECE)]
        else:
            ends[node[lo]] = hashlib.sha256(",".join(map(str, ids[lo:hi].tolist())).encode()).hexdigest()
    return ends, pieces


def _solve(keys: list[bytes], t: pa.Table, number: int, bottom: bool, top: bool) -> Iterator[pa.RecordBatch]:
    flat = lambda c: t.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)  # noqa: E731
    ids = t.column("conv_id").to_numpy()
    shard = Shard(keys, ids, flat("words"), None if bottom else {c: flat(c) for c in ("members", "kids", "leaves", "saved", "low")})
    m = len(shard.depth)
    spine = np.zeros(m, bool)
    if not top:
        spine[shard.path(0)] = spine[shard.path(len(keys) - 1)] = True
    children, leaves, saved = shard.totals(spine)
    ends, pieces = _ended(shard, ids, spine) if bottom else (np.full(m, None, object), [])
    final = np.flatnonzero(~spine)
    above = shard.parent[final]
    open_parent = (above >= 0) & spine[above]
    # above the bottom every node has a place, by which nodes below find their parents and ended ids their nodes
    prefix = lambda v: keys[shard.first[v]][:NAME * shard.depth[v]]  # noqa: E731
    known: dict[int, bytes] = {}

    def place(v: int) -> bytes:
        if v not in known:
            known[v] = _place(prefix(v))
        return known[v]

    for at in range(0, len(final), 1 << 16):
        v, up, wait = (x[at:at + (1 << 16)] for x in (final, above, open_parent))
        yield _rows(len(v), kind=pa.array(np.full(len(v), _FINAL, np.int8)), shard=pa.array(np.full(len(v), number)),
                    place=pa.nulls(len(v), pa.binary()) if bottom else pa.array([place(x) for x in v.tolist()], pa.binary()),
                    conv_id=pa.array(shard.least[v]), depth=pa.array(shard.depth[v]),
                    parent=pa.array(shard.least[up], mask=wait | (up < 0)),
                    parent_place=pa.array([place(u) if w else None for u, w in zip(up.tolist(), wait.tolist())], pa.binary()),
                    n_convs=pa.array(shard.members[v]), n_children=pa.array(children[v]), n_leaves=pa.array(leaves[v]),
                    saved_tokens=pa.array(saved[v]), ends=pa.array(ends[v].tolist(), pa.string()))
    if top:
        return
    # the spines: a node on both counts with the first
    told = np.zeros(m, bool)
    for key in (0, len(keys) - 1)[:1 + (len(keys) > 1)]:
        v = shard.path(key)
        once = np.where(told[v], 0, 1)
        told[v] = True
        lists = {c: pa.array([(x[v] * once).tolist()], pa.list_(pa.int64())) for c, x in (
            ("members", shard.members), ("kids", children), ("leaves", leaves), ("saved", saved))}
        yield _rows(1, kind=pa.array([_SPINE], pa.int8()), shard=pa.array([number]), conv_id=pa.array([int(shard.least[v[-1]])]),
                    low=pa.array([shard.least[v].tolist()], pa.list_(pa.int64())), key=pa.array([keys[key]], pa.binary()), words=pa.array([shard.words[v[1:]].tolist()], pa.list_(pa.int64())),
                    places=pa.array([[place(x) for x in v.tolist()]], pa.list_(pa.binary())), **lists)
    for v, first, text in pieces:
        yield _rows(1, kind=pa.array([_IDS], pa.int8()), shard=pa.array([number]), place=pa.array([place(int(v))], pa.binary()),
                    conv_id=pa.array([int(first)]), ids=pa.array([text]))


# -- all shards ---------------------------------------------------------------------------------------------------

def _shards(bottom: bool, top: bool, shard_size: int):
    """Sorted rows of one partition, cut into shards -> their nodes, spines and pieces of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        number, held, size, rows = TaskContext.get().partitionId() << 32, [], 0, 0

        def solved() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            yield from _solve(t.column("key").to_pylist(), t, number, bottom, top)

        for b in batches:
            ends = np.cumsum(pc.binary_length(b.column("key")).to_numpy(zero_copy_only=False).astype(np.int64) // NAME + 1)
            at = 0
            while at < b.num_rows:
                base = ends[at - 1] if at else 0
                stop = b.num_rows if top else int(np.searchsorted(ends, base + shard_size - size, side="right"))
                stop = min(max(stop, at + 1 if rows >= _FEWEST else at + _FEWEST - rows), b.num_rows)
                held.append(b.slice(at, stop - at))
                size, rows, at = size + int(ends[stop - 1] - base), rows + stop - at, stop
                if not top and size >= shard_size and rows >= _FEWEST:
                    yield from solved()
                    number, held, size, rows = number + 1, [], 0, 0
        if held:
            yield from solved()

    return run


def _joined_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of ids, sorted by place and first id -> (place, ends)."""
    place, state = None, None
    done = lambda: pa.RecordBatch.from_arrays([pa.array([place], pa.binary()), pa.array([state.hexdigest()])],  # noqa: E731
                                              names=["place", "hash"])
    for b in batches:
        for own, text in zip(b.column("place").to_pylist(), b.column("ids")):
            if own != place:
                if place is not None:
                    yield done()
                place, state = own, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.as_buffer())
    if place is not None:
        yield done()


def _level(keys: DataFrame, bottom: bool, shard_size: int) -> DataFrame:
    """The final nodes of the trie of ``keys`` (written before), with the places of those above the bottom."""
    spark = keys.sparkSession
    n, size = keys.agg(F.count("*"), F.sum(F.octet_length("key") / NAME + 1)).first()
    size = size or 0
    top = not bottom and (size <= shard_size or n <= _FEWEST)
    parts = min(-(-int(size) // shard_size), -(-n // _FEWEST))
    if bottom:
        parts = max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = keys.repartition(1) if top else keys.repartitionByRange(max(1, parts), "key", "conv_id")
    made = written(dealt.sortWithinPartitions("key", "conv_id").mapInArrow(_shards(bottom, top, shard_size), _NODE_SQL), "trie-nodes")
    names = ["place", "conv_id", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    final = made.filter(F.col("kind") == _FINAL).select("shard", "parent_place", *names)
    if top:
        return final.select(*names)
    spines = made.filter(F.col("kind") == _SPINE)
    upper = written(_level(spines.select("key", "conv_id", "words", "members", "kids", "leaves", "saved", "low"), False,
                           shard_size), "trie-upper")
    # right below a spine: the parent is known now. By shard and place, so that no parent is a hot key
    known = written(spines.select(F.col("shard").alias("of_shard"), F.explode("places").alias("place")).distinct().join(
        upper.select("place", F.col("conv_id").alias("up")), "place"), "trie-parents")
    waiting = final.filter(F.col("parent_place").isNotNull()).drop("parent")
    waiting = waiting.join(known.withColumnRenamed("place", "of_place"), (F.col("shard") == F.col("of_shard")) & (
        F.col("parent_place") == F.col("of_place"))).withColumn("parent", F.col("up"))
    if bottom:
        pieces = made.filter(F.col("kind") == _IDS).select("place", "conv_id", "ids")
        hashes = pieces.repartition("place").sortWithinPartitions("place", "conv_id").drop("conv_id").mapInArrow(
            _joined_hash, "place binary, hash string")
        upper = upper.drop("ends").join(written(hashes, "trie-ends"), "place", "left").withColumn(
            "ends", F.coalesce("hash", F.lit(_EMPTY)))
    return (final.filter(F.col("parent_place").isNull()).select(*names).unionByName(waiting.select(*names))
            .unionByName(upper.select(*names)))


def trie(keys: DataFrame, shard_size: int = SHARD) -> DataFrame:
    """The nodes of the trie of ``keys`` (conv_id long, key binary, words array<int>), one row each."""
    ship_package(keys.sparkSession)
    nodes = _level(written(keys, "trie-keys"), True, shard_size)
    return nodes.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                        "saved_tokens", F.col("ends").alias("ends_sha256"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(rebuilt(table(spark, sf_dir, "conversations")))


# crc32 of a number's decimal digits, bit by bit; only its last two bits count
_CRC = """list_reduce(list_concat([4294967295::bigint], list_transform(string_split(conv_id::varchar, ''), lambda c: ord(c)::bigint)),
  lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, bit: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))"""

ORACLE_SQL = rf"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, xor({_CRC}, 4294967295) % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, t.n, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.n <= c.h
  UNION ALL
  SELECT c.conv_id, t.n, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.n > c.h),
placed AS (
  SELECT conv_id, text, row_number() OVER w AS depth,
         list(md5(strlen(role)::varchar || ':' || role || text)) OVER w AS path
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY n)),
member AS (
  SELECT conv_id, depth, array_to_string(path, '') AS path, text FROM placed
  UNION ALL SELECT conv_id, 0, '', '' FROM convs),
ended AS (SELECT conv_id, max(depth) AS depth, max_by(path, depth) AS path FROM member GROUP BY conv_id),
ends AS (SELECT path, sha256(string_agg(conv_id::varchar, ',' ORDER BY conv_id)) AS hash FROM ended GROUP BY path),
node AS (
  SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         any_value(len(regexp_extract_all(text, '[^ 	

]+'))) AS words
  FROM member GROUP BY path),
kids AS (SELECT left(path, (32 * depth - 32)::int) AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
full_node AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (path)),
above AS (
  SELECT left(path, (32 * d)::int) AS path, n_children = 0 AS leaf, (n_convs - 1) * words AS worth
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM full_node)),
total AS (SELECT path, count(*) FILTER (WHERE leaf) AS n_leaves, sum(worth) AS saved FROM above GROUP BY path)
SELECT v.conv_id, CAST(v.depth AS bigint) AS depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves,
       CAST(saved AS bigint) AS saved_tokens, coalesce(hash, sha256('')) AS ends_sha256
FROM full_node v JOIN total USING (path) LEFT JOIN ends USING (path)
LEFT JOIN node up ON v.depth > 0 AND up.path = left(v.path, (32 * v.depth - 32)::int)
"""
