"""b-bit MinHash near-duplicates.

A text is lower-cased (A-Z), cut into words at ASCII white space and into the set of its distinct shingles. Each shingle is
named by a 64-bit hash of its words; LANES multiply-shift hashes of these names have one minimum each. Runs of ROWS minima
are hashed to the document's band keys; of every minimum only the low BITS are kept, and packed into the signature.

Documents with equal sets are one class, and only one row of a class goes on. Classes that share a band key are compared by
signature: the bits are counted in which two signatures differ, lane by lane, and the share of equal lanes is corrected for
chance collisions, R = (equal - C) / (1 - C) with C = 2^-BITS (``similarity``). Pairs whose signatures are as near as those of
linked sets (``least_equal``) join classes to clusters, and in a cluster links are confirmed on the full sets.

Both steps compare the members of groups (``links``): buckets of a band key first, clusters after that. A group is cut into
chunks of bounded size that each get the group's least member too; a chunk is one task, which joins its members by the
links found and returns a star for each joined set, never all pairs. A group whose chunks are all one star, by the least
member that they share, is done. Of the others, chunks are compared two by two, so that no pair of unjoined members is
left out.

Bounds: a link of similarity t is missed by all bands with probability (1 - t^ROWS)^BANDS (7e-9 at 0.85) and dropped by its
signature with at most MISSED; no bucket, cluster or candidate is capped. A task holds CHUNK rows or CHUNK_BYTES of sets.

Defined results: a text of fewer words than a shingle is one shingle, which is linked with equal texts only; a null, empty or
blank text has no shingle and is linked with nothing; a group's id is its least non-null doc_id (null if it has none), and a
row without an id and without any other in its group counts as kept; repeated rows and ids are each returned; extra columns
are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm.common import slices, table, written
from fleetscope.llm.components import components
from fleetscope.llm.simhash import stars
from fleetscope.session import ship_package

SHINGLE = 3
#: Least similarity of a link, in hundredths.
PERCENT = 85
BANDS, ROWS = 32, 5
LANES = BANDS * ROWS
#: Low bits of a minimum that are kept.
BITS = 4
#: Most probability that the signature alone drops a link.
MISSED = 1e-9
#: Rows of a task, and bytes of their sets.
CHUNK, CHUNK_BYTES = 1024, 32 << 20
#: Bits of the map of wanted texts (4 MB); the most of them that are told apart before texts are shuffled.
MAP_BITS = 1 << 25
#: Shingles whose hashes are made at once.
_RUN = 512
_SEED = 13


# -- sets and signatures ------------------------------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """64-bit hashes of words, made when they are first met; emptied when there are very many."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word, _SEED)
        return h


class Hasher:
    """Sets, minima, band keys and packed signatures of texts."""

    def __init__(self, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, bits: int = BITS):
        if bits not in (1, 2, 4, 8):
            raise ValueError("bits must be 1, 2, 4 or 8")
        self.shingle, self.bands, self.rows, self.bits = shingle, bands, rows, bits
        rng = np.random.default_rng(_SEED)
        draw = lambda n: rng.integers(0, 2 ** 64, n, dtype=np.uint64)
        self.places = draw(shingle) | np.uint64(1)
        self.a, self.b = (draw(bands * rows) | np.uint64(1))[:, None], draw(bands * rows)[:, None]
        self.keys, self.band = draw(rows) | np.uint64(1), draw(bands)
        self.words = _Words()
        self.space = np.empty((bands * rows, _RUN), np.uint64)

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted distinct names of the text's shingles."""
        own = text.encode().lower().split() if text else []
        if not own:
            return np.zeros(0, np.uint64)
        w = np.fromiter(map(self.words.__getitem__, own), np.uint64, len(own))
        k = min(self.shingle, len(w))
        n = len(w) - k + 1
        h = np.full(n, k, np.uint64)
        for i in range(k):
            h += w[i:i + n] * self.places[i]
        return np.unique(_mixed(h))

    def minima(self, names: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), 2 ** 64 - 1, np.uint64)
        for at in range(0, len(names), _RUN):
            part = names[at:at + _RUN]
            h = self.space[:, :len(part)]
            np.multiply(self.a, part, out=h)
            np.add(h, self.b, out=h)
            np.minimum(least, h.min(axis=1), out=least)
        return least >> np.uint64(32)

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        keys = (minima.reshape(self.bands, self.rows) * self.keys).sum(axis=1, dtype=np.uint64)
        return _mixed(keys ^ self.band)

    def signature(self, minima: np.ndarray) -> np.ndarray:
        """The low bits of the minima, packed into 64-bit numbers (the last one filled up with zeros)."""
        per = 64 // self.bits
        low = minima & np.uint64((1 << self.bits) - 1)
        low = np.concatenate([low, np.zeros(-len(low) % per, np.uint64)]).reshape(-1, per)
        return np.bitwise_or.reduce(low << (np.arange(per, dtype=np.uint64) * np.uint64(self.bits)), axis=1)


def equal_lanes(x: np.ndarray, y: np.ndarray, lanes: int = LANES, bits: int = BITS) -> np.ndarray:
    """The number of equal lanes of packed signatures, by counting bits (last axis: a signature's 64-bit numbers)."""
    d = x ^ y
    step = bits >> 1
    while step:  # a lane that differs anywhere gets its lowest bit
        d = d | (d >> np.uint64(step))
        step >>= 1
    ones = np.uint64(sum(1 << k for k in range(0, 64, bits)))
    return lanes - np.bitwise_count(d & ones).sum(axis=-1, dtype=np.int64)


def similarity(equal, lanes: int = LANES, bits: int = BITS):
    """The similarity that a number of equal lanes speaks for, corrected for lanes that are equal by chance."""
    chance = 2.0 ** -bits
    return (equal / lanes - chance) / (1 - chance)


def least_equal(percent: int = PERCENT, lanes: int = LANES, bits: int = BITS, missed: float = MISSED) -> int:
    """The most lanes that can be asked for so that sets of the least similarity have fewer with at most ``missed``."""
    r = percent / 100
    p = r + (1 - r) * 2.0 ** -bits
    below, k = 0.0, 0
    while k < lanes and (below := below + comb(lanes, k) * p ** k * (1 - p) ** (lanes - k)) <= missed:
        k += 1
    return k


def prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(row, id, text_hash, n_shingles, digest, bands, signature) of every row; no bands where there is no shingle."""
    ship_package(docs.sparkSession)
    text = F.col(text_col).cast("string")
    picked = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                         F.xxhash64(text).alias("text_hash"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        make = Hasher(shingle)
        for part in slices(batches, 3):
            n, digest, bands, signature = [], [], [], []
            for text in part.column(3).to_pylist():
                names = make.shingles(text)
                n.append(len(names))
                digest.append(xxhash.xxh3_128_digest(names.tobytes(), _SEED))
                if len(names):
                    minima = make.minima(names)
                    bands.append(make.band_keys(minima).view(np.int64))
                    signature.append(make.signature(minima).tobytes())
                else:
                    bands.append(None)
                    signature.append(None)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:3], pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(signature, pa.binary())],
                names=["row", "id", "text_hash", "n_shingles", "digest", "bands", "signature"])

    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"row long, id {kind}, text_hash long, n_shingles long, digest binary, bands array<long>, "
                                  "signature binary")


def _maybe_wanted(texts: DataFrame, wanted: DataFrame, bits: int = MAP_BITS) -> DataFrame:
    """``texts`` without most of those whose ``text_hash`` is not among ``wanted``, by a map of one bit a hash: ``bits`` / 8
    bytes are broadcast, whatever the size of the tables. With very many wanted hashes it lets more through; a join decides."""
    place = F.pmod(F.col("text_hash"), F.lit(bits)) + 1
    maps = wanted.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("map"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("map"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return texts.join(F.broadcast(maps), F.bitmap_bucket_number(place) == F.col("bucket")).where(
        F.getbit(byte, (at % 8).cast("int")) == 1).drop("bucket", "map")


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(member, shingles) of ``wanted`` (member, id, text_hash; written before), from the texts: only theirs are read into sets."""
    text = F.col(text_col).cast("string")
    named = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("of_id"), F.xxhash64(text).alias("text_hash"),
                        text.alias("text"))
    wanted = wanted.select("member", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("of_id"), "text_hash")
    # repeated rows have the same id and text; one is enough
    picked = _maybe_wanted(named, wanted).join(wanted, ["of_id", "text_hash"]).select("member", "text").dropDuplicates(["member"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Hasher(shingle)
        for part in slices(batches, 1):
            sets = [make.shingles(t).tobytes() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["member", "shingles"])

    return picked.mapInArrow(run, "member long, shingles binary")


# -- links inside groups ------------------------------------------------------------------------------------------

def _near(signature: np.ndarray, task: np.ndarray, side: np.ndarray, root: np.ndarray,
          least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of one task with near signatures and different roots; sides: 0 with itself, 1 with 2. Rows are sorted by task."""
    found, n = [], len(task)
    size = np.diff(np.append(np.flatnonzero(np.append(True, task[1:] != task[:-1])), n)).max(initial=0)
    at = np.arange(n)
    for d in range(1, size):
        at = at[at < n - d]
        at = at[task[at] == task[at + d]]  # a task's rows lie together: a pair that is too wide stays so
        i = at[((side[at] == 0) | (side[at] != side[at + d])) & (root[at] != root[at + d])]
        for k in range(0, len(i), 1 << 16):
            a = i[k:k + (1 << 16)]
            near = equal_lanes(signature[a], signature[a + d]) >= least
            found.append((a[near], a[near] + d))
    return found


def _estimated(rows: dict[str, np.ndarray], least: int) -> np.ndarray:
    """The index of the row that each row is joined to by near signatures, task by task."""
    return stars(len(rows["task"]), _near(rows["signature"], rows["task"], rows["side"], rows["root"], least))


def _confirmed(rows: dict[str, np.ndarray], least: int, percent: int) -> np.ndarray:
    """The same by links that the full sets confirm; of members that are joined already no pair is compared."""
    sets, n, out = rows["shingles"], rows["n"], []
    starts = np.append(np.flatnonzero(np.append(True, rows["task"][1:] != rows["task"][:-1])), len(n))
    for lo, hi in zip(starts[:-1], starts[1:]):
        label = np.unique(rows["root"][lo:hi], return_inverse=True)[1]
        side, size, signature = rows["side"][lo:hi], n[lo:hi], rows["signature"][lo:hi]
        for i in range(hi - lo - 1):
            j = np.arange(i + 1, hi - lo)
            j = j[(label[j] != label[i]) & ((side[j] != side[i]) | (side[i] == 0))
                  & (100 * np.minimum(size[j], size[i]) >= percent * np.maximum(size[j], size[i]))]
            j = j[equal_lanes(signature[i], signature[j]) >= least] if len(j) else j
            for k in j.tolist():
                if label[k] == label[i]:
                    continue
                both = len(np.intersect1d(sets[lo + i], sets[lo + k], assume_unique=True))
                if 100 * both >= percent * (int(size[i]) + int(size[k]) - both):
                    label[label == label[k]] = label[i]
        first, of = np.unique(label, return_index=True, return_inverse=True)[1:]
        out.append(lo + first[of])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _walk(percent: int, confirm: bool):
    """Rows (task, side, root, signature[, shingles]) sorted by task, each task in one partition -> edges (task, a, b)
    between roots, a star for each joined set of a task."""
    least = least_equal(percent)

    def edges(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        rows = {c: t.column(c).to_numpy() for c in ("task", "side", "root")}
        rows["signature"] = np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint64).reshape(t.num_rows, -1)
        order = np.lexsort((rows["root"], rows["side"], rows["task"]))
        rows = {c: x[order] for c, x in rows.items()}
        if confirm:
            sets = [np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()]
            rows["shingles"] = [sets[i] for i in order.tolist()]
            rows["n"] = np.array([len(x) for x in rows["shingles"]])
        to = rows["root"][_confirmed(rows, least, percent) if confirm else _estimated(rows, least)]
        at = np.flatnonzero(to != rows["root"])
        found = np.unique(np.stack([rows["task"][at], rows["root"][at], to[at]]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["task", "a", "b"])

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


def links(members: DataFrame, payload: DataFrame | None = None, percent: int = PERCENT, chunk: int = CHUNK,
          chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Edges (a, b) that join all members of a group that are linked. ``members``: group long, member long; ``payload``:
    member, signature and, to confirm links on them, shingles. Both written before. Members that are alone in their group
    are left out first, so that only the others' signatures and sets are moved. Without ``payload``, ``members`` has its columns."""
    confirm = "shingles" in (members if payload is None else payload).columns
    extra = ["signature", "shingles"] if confirm else ["signature"]
    sized = members
    if confirm:
        size = F.octet_length("shingles").alias("bytes")
        sized = (members.select("group", "member", size) if payload is None
                 else members.join(payload.select("member", size), "member"))
    weight = F.sum(F.col("bytes").cast("long")) if confirm else F.lit(0).cast("long")
    parts = F.greatest(F.ceil(F.count("*") / chunk), F.ceil(weight / chunk_bytes)).cast("int")
    groups = written(sized.groupBy("group").agg(F.count("*").alias("count"), F.min("member").alias("center"),
                                                parts.alias("parts")).filter("count > 1").drop("count"), "minhash-groups")
    part = F.pmod(F.xxhash64("member", F.lit("part")), F.col("parts")).cast("int")
    rows = members.join(groups, "group").withColumn("part", part)
    if payload is not None:
        rows = rows.select("group", "member", "center", "parts", "part").join(payload, "member")
    task = F.xxhash64("group", "part").alias("task")
    rows = rows.select("group", "member", "center", "parts", "part", *extra)
    many = not groups.filter("parts > 1").isEmpty()
    if many:  # read by three steps
        rows = written(rows, "minhash-rows")
    tasks = rows.select("group", "part", "member", *extra)
    if many:  # the least member is in every chunk
        center = rows.filter("parts > 1 and member = center")
        everywhere = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: p != F.col("part"))
        tasks = tasks.unionByName(center.select("group", F.explode(everywhere).alias("part"), "member", *extra))
    found = _edges(tasks.select(task, F.lit(0).alias("side"), F.col("member").alias("root"), *extra), percent, confirm)
    if not many:
        return found.select("a", "b")
    found = written(found, "minhash-links")
    # the root of a member is the least one that its chunk joins it to; the shared member's star has the same in all chunks
    star = found.select("task", F.col("a").alias("member"), F.col("b").alias("root"))
    rows = written(rows.filter("parts > 1").withColumn("task", task).join(star, ["task", "member"], "left")
                   .withColumn("root", F.coalesce("root", "member")).drop("task"), "minhash-open")
    apart = rows.groupBy("group").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
    rows = rows.join(apart.select("group"), "group", "left_semi")
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: p != F.col("part"))
    rows = rows.select("*", F.explode(others).alias("other"))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    pairs = _edges(rows.select(F.xxhash64("group", low, high).alias("task"),
                               F.when(F.col("part") < F.col("other"), 1).otherwise(2).alias("side"), "root", *extra),
                   percent, confirm)
    return found.unionByName(pairs).select("a", "b")


def _edges(rows: DataFrame, percent: int, confirm: bool) -> DataFrame:
    return rows.repartition("task").sortWithinPartitions("task").mapInArrow(_walk(percent, confirm), "task long, a long, b long")


# -- the operator -------------------------------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                    chunk: int = CHUNK) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of ``docs``."""
    ship_package(docs.sparkSession)
    made = written(prints(docs, id_col, text_col), "minhash-prints")
    # documents of equal sets are one class, which its first row stands for
    classes = written(made.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("row").alias("first"), F.min("id").alias("least")), "minhash-classes")
    firsts = written(made.select(F.col("row").alias("member"), "id", "text_hash", "bands", "signature").join(
        classes.select(F.col("first").alias("member")), "member", "left_semi"), "minhash-firsts")
    buckets = firsts.select(F.explode("bands").alias("group"), "member")
    near = links(buckets, firsts.select("member", "signature"), percent, chunk)
    clusters = components(near, "a", "b").select(F.col("node").alias("member"), F.col("root").alias("group"))
    picked = written(firsts.select("member", "id", "text_hash", "signature").join(clusters, "member"), "minhash-picked")
    sets = full_sets(docs, picked, id_col, text_col).join(picked.select("group", "member", "signature"), "member")
    sets = written(sets.select("group", "member", "signature", "shingles"), "minhash-sets")
    linked = components(links(sets, percent=percent, chunk=chunk), "a", "b")

    rooted = written(classes.join(linked.withColumnRenamed("node", "first"), "first", "left").select(
        "digest", "least", F.coalesce("root", "first").alias("root")), "minhash-rooted")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component"))
    given = rooted.join(ids, "root").select(F.col("digest").alias("of"), "component")
    alone = F.col("n_shingles") == 0
    component = F.when(alone, F.col("id")).otherwise(F.col("component"))
    return made.select("id", "n_shingles", "digest").join(given, F.col("digest") == F.col("of"), "left").select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
