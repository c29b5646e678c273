"""Sharding by balanced label propagation with DataFrame joins.

Documents of one group (by default: equal texts) are linked. The labels are shards; all linked documents of one group in
one shard see the same neighbours, so that the state is the number of members by (group, shard) and never their pairs.
Documents without a link have no neighbours; they fill what is left, so that the shards' row counts differ by at most one
(law ``rows``).

Propagation starts from the shard of a hash. A group's targets are its largest shards, as many as it fills (one, if it fits
a shard); equal ones are ranked anew in each round. The members outside wish to move to a target that holds at least as
many; a cell in a closed shard moves whole to any target of its group. Wishes are granted by pairs of shards: equal numbers from s to t and from t to s, equal numbers around longer cycles, then what
the room of t takes, then what groups that lie wholly in t and can be moved to s without a loss make room for. Such groups also leave shards that
the start has overfilled. The wishes of a pair are granted in the order of the members at the target; the sums by pair of
shards are all that the driver sees, and running sums are over cells (group, shard), cut into blocks by a hash, not over
rows. A shard that gets none of its wishes is closed as a target until a member leaves it or nothing moves. Each granted wish raises the
number of linked pairs in one shard, so that rounds end: they stop after ``PATIENCE`` rounds without a gain. Last, a shard
that is still overfilled gives up its smallest cells.

Then the members of a group are numbered; the numbers are dealt to its shards by their counts, and the documents without
a link are numbered and dealt to the room that is left. Numbers come from counts by (group, bucket) and a window within
a bucket, so that a group with a third of all rows is not numbered in one task; slots are made likewise.

Defined results: a null text counts as no bytes and as a group with the empty texts; ids that are null or repeat are
rows like others; fewer rows than shards leave the last shards empty; an empty table gives an empty table; extra columns
are not read.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetscope.llm.common import table, written

SHARDS = 24
#: Rounds without a gain after which propagation ends.
PATIENCE = 4
#: Rows of one bucket within which rows are numbered by a window.
BUCKET_ROWS = 8192
#: The same for the members of one group.
GROUP_BUCKET_ROWS = 1024
#: Buckets whose running sum is made at once.
LEVEL = 4096


def _numbered(rows: DataFrame, by: list[str], order: list[str], bucket: Column, out: str, name: str) -> DataFrame:
    """Adds ``out``: 0, 1, 2, ... within each ``by``, by bucket and then ``order``. ``bucket`` is a hash bucket of a row."""
    rows = rows.withColumn("__bucket", bucket)
    # running sums in two levels, so that no window holds a row for every bucket
    many = F.floor(F.col("__bucket") / LEVEL)
    sizes = written(rows.groupBy(*by, "__bucket").agg(F.count("*").alias("__n")).withColumn("__many", many), name)
    so_far = lambda of, order: F.coalesce(F.sum("__n").over(
        W.partitionBy(*of).orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    above = sizes.groupBy(*by, "__many").agg(F.sum("__n").alias("__n")).withColumn("__above", so_far(by, "__many")).drop("__n")
    sizes = sizes.withColumn("__within", so_far([*by, "__many"], "__bucket")).join(above, [*by, "__many"])
    sizes = written(sizes.select(*by, "__bucket", (F.col("__above") + F.col("__within")).alias("__before")), name)
    own = F.row_number().over(W.partitionBy(*by, "__bucket").orderBy(*order)) - 1
    rows = written(rows.withColumn("__own", own), name)
    return rows.join(sizes, [*by, "__bucket"]).withColumn(out, (F.col("__before") + F.col("__own")).cast("long")).drop(
        "__bucket", "__before", "__own")


def _capacities(spark: SparkSession, n: int, shards: int) -> DataFrame:
    """(shard, capacity): n rows dealt evenly, the first shards get the rest."""
    return spark.range(shards).select(F.col("id").cast("int").alias("shard"), (
        F.lit(n // shards) + F.when(F.col("id") < n % shards, 1).otherwise(0)).cast("long").alias("capacity"))


def _granted(wishes: DataFrame, room: DataFrame, by: list[str]) -> DataFrame:
    """(group, from, to, n): what of each wish (group, from, to, n, there) fits the ``room`` of its ``by``, larger ``there``
    first; a wish with ``there`` below ``n`` is granted whole or not at all. Running sums by (by, there) and within by a hash block keep any window small."""
    wishes = wishes.withColumn("block", F.pmod(F.xxhash64("group"), F.lit(1024)))
    level = wishes.groupBy(*by, "there", "block").agg(F.sum("n").alias("sum"))
    of_level = W.partitionBy(*by).orderBy(F.desc("there"), "block").rowsBetween(W.unboundedPreceding, -1)
    level = level.select(*by, "there", "block", F.coalesce(F.sum("sum").over(of_level), F.lit(0)).alias("before"))
    within = W.partitionBy(*by, "there", "block").orderBy("group", "from").rowsBetween(W.unboundedPreceding, -1)
    return (wishes.withColumn("within", F.coalesce(F.sum("n").over(within), F.lit(0)))
            .join(level, [*by, "there", "block"]).join(F.broadcast(room), by)  # room: shards or pairs of shards
            .withColumn("fits", F.least("n", F.col("room") - F.col("before") - F.col("within")))
            .filter(F.col("fits") >= F.when(F.col("there") < F.col("n"), F.col("n")).otherwise(1))
            .select("group", "from", "to", F.col("fits").alias("n")))


def _wishes(cells: DataFrame, shut: set[int], largest: int, salt: int) -> DataFrame:
    """(group, from, n, alone, to, there) of every cell: ``to`` is null for those that stay, ``alone`` true for the only
    cell of a group. ``shut``: shards that are no targets."""
    of_group = W.partitionBy("group")
    rank = F.struct((-F.col("n")).alias("less"), F.xxhash64("group", "shard", F.lit(salt)).alias("h"), F.col("shard").alias("shard"))
    cells = cells.withColumn("own", rank).withColumns({
        "cells": F.count("*").over(of_group), "rows": F.sum("n").over(of_group), "all": F.array_sort(F.collect_list("own").over(of_group))})
    is_open = lambda shard: ~shard.isin(*sorted(shut)) if shut else F.lit(True)
    targets = F.slice(F.filter("all", lambda c: is_open(c["shard"])), F.lit(1), F.ceil(F.col("rows") / largest).cast("int"))
    cells = cells.withColumn("targets", targets).withColumn("no", F.array_position("all", F.col("own")))
    to = F.when(F.size("targets") > 0, F.get("targets", ((F.col("no") + salt) % F.size("targets")).cast("int")))
    larger = (to < F.col("own")) & ~F.array_contains("targets", F.col("own"))
    to = F.when(larger | (~is_open(F.col("shard")) & (F.size("targets") == 1)), to)
    return cells.withColumn("target", to).select(
        "group", F.col("shard").alias("from"), "n", (F.col("cells") == 1).alias("alone"), F.col("target.shard").alias("to"),
        (-F.col("target.less")).alias("there"))


def _cycle(rest: dict) -> list:
    """Pairs (from, to) of ``rest`` with a number above 0 that form a cycle; empty if there is none."""
    follow: dict = {}
    for (s, t), n in sorted(rest.items()):
        if n > 0:
            follow.setdefault(s, []).append(t)
    done: set = set()
    for start in sorted(follow):
        path, ways = [start], [iter(follow[start])]
        while path:
            t = next((t for t in ways[-1] if t not in done), None)
            if t is None:
                done.add(path.pop())
                ways.pop()
            elif t in path:
                path = [*path[path.index(t):], t]
                return list(zip(path, path[1:]))
            else:
                path.append(t)
                ways.append(iter(follow.get(t, ())))
    return []


def _quotas(wished: dict, room: dict) -> tuple[Counter, Counter]:
    """What is granted of the wishes by (from, to): exchanges, and what fits the room; and what leaves overfilled shards.
    ``room`` becomes what is left."""
    granted = Counter({(s, t): min(n, wished.get((t, s), 0)) for (s, t), n in wished.items()})
    rest = {p: n - granted[p] for p, n in wished.items()}
    while cycle := _cycle(rest):
        n = min(rest[p] for p in cycle)
        for p in cycle:
            granted[p] += n
            rest[p] -= n
    pushed = Counter()
    for s in sorted(room):
        for t in sorted(room):
            if (n := min(-room[s], room[t])) > 0:
                pushed[s, t] += n
                room[s] += n
                room[t] -= n
    for (s, t), n in sorted(wished.items(), key=lambda x: (granted[x[0]] - x[1], x[0])):
        if (n := min(n - granted[s, t], room[t])) > 0:
            granted[s, t] += n
            room[s] += n
            room[t] -= n
    return granted, pushed


def _made_room(wishes: DataFrame, quotas: dict, salt: int) -> DataFrame:
    """(group, from, to, n): whole groups that move from s to t, at most ``quotas`` rows by (s, t)."""
    rows, ends = [], Counter()
    for (s, t), n in sorted(quotas.items()):
        rows.append((s, t, n, ends[s], ends[s] + n))
        ends[s] += n
    spark = wishes.sparkSession
    pairs = spark.createDataFrame([(*r, ends[r[0]]) for r in rows], "`from` int, `to` int, room long, low long, high long, total long")
    # each group is offered to one shard, by a hash in proportion to the quotas
    at = F.pmod(F.xxhash64("group", F.lit(salt)), F.col("p.total"))
    offers = wishes.filter("alone").alias("w").join(F.broadcast(pairs.alias("p")), (F.col("w.from") == F.col("p.from")) & (
        F.col("w.n") <= F.col("p.room")) & (F.col("p.low") <= at) & (at < F.col("p.high")))
    return _granted(offers.select("group", "w.from", "p.to", "n", (-F.col("n")).alias("there")), pairs.select(
        "from", "to", "room"), ["from", "to"])


def propagate(cells: DataFrame, capacities: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Label propagation over (group, shard, n), the linked documents; the result has the same columns, and no shard has
    more than its capacity. ``capacities``: (shard, capacity), a row for each shard."""
    spark = cells.sparkSession
    capacity = {r.shard: r.capacity for r in capacities.collect()}
    largest = max(1, *capacity.values())
    by_pair = "`from` int, `to` int, room long"
    shut, idle, salt, best = set(), 0, 0, (0, 0)
    while idle < PATIENCE and (max_rounds is None or salt < max_rounds):
        wishes = written(_wishes(cells, shut, largest, salt), "shard-wishes")
        room, wished = dict(capacity), {}
        n, linked = F.col("n"), 0
        for r in wishes.groupBy("from", "to").agg(F.sum(n).alias("n"), F.sum(n.cast("decimal(19,0)") * n).alias("linked")).collect():
            room[r["from"]] -= r.n
            linked += int(r.linked)
            if r.to is not None:
                wished[r["from"], r.to] = r.n
        if not wished and not shut and min(room.values()) >= 0:
            break
        score = linked, sum(min(x, 0) for x in room.values())
        idle, best = (0, score) if score > best else (idle + 1, best)
        granted, pushed = _quotas(wished, room)
        moves = []
        asked = pushed + Counter({(t, s): n - granted[s, t] for (s, t), n in wished.items()})
        if asked:
            made = written(_made_room(wishes, asked, salt), "shard-made-room")
            gone = Counter({(r["from"], r.to): r.n for r in made.groupBy("from", "to").agg(F.sum("n").alias("n")).collect()})
            for (t, s), n in gone.items():
                granted[s, t] += max(0, n - pushed[t, s])
            if gone:
                moves.append(made)
        granted = +granted
        if granted:
            moves.append(_granted(wishes.filter("to is not null"), spark.createDataFrame(
                [(*pair, n) for pair, n in granted.items()], by_pair), ["from", "to"]))
        reached, left = {t for _, t in granted}, {s for s, _ in granted}
        now = (shut | {t for _, t in wished} - reached) - left
        shut, salt = now if moves or not shut else set(), salt + 1
        for m in moves:
            change = m.select("group", F.col("from").alias("shard"), (-F.col("n")).alias("n")).unionByName(
                m.select("group", F.col("to").alias("shard"), "n"))
            cells = cells.unionByName(change)
        if moves:
            cells = written(cells.groupBy("group", "shard").agg(F.sum("n").alias("n")).filter("n > 0"), "shard-cells")
    stay = cells.select("group", F.col("shard").alias("from"), F.col("shard").alias("to"), "n", F.col("n").alias("there"))
    kept = _granted(stay, capacities.select(F.col("shard").alias("to"), F.col("capacity").alias("room")), ["to"])
    return written(kept.select("group", F.col("to").alias("shard"), "n"), "shard-cells")


def _bucket(rows: Column | int, size: int = BUCKET_ROWS) -> Column:
    """A hash bucket of about ``size`` of ``rows`` rows. The row is hashed beside its id, as ids can be null or repeat."""
    n = F.greatest(F.lit(1), F.ceil((rows if isinstance(rows, Column) else F.lit(rows)) / size))
    return F.pmod(F.xxhash64("id", "row"), n.cast("long"))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
          max_rounds: int | None = None) -> DataFrame:
    """(id, size, text_crc32, group, group_rows, shard, slot) of every row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = written(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.substring(F.sha2(text, 256), 1, 32).alias("group"),
        F.monotonically_increasing_id().alias("row")), "shard-rows")
    groups = written(rows.groupBy("group").agg(F.count("*").alias("group_rows")), "shard-groups")
    n = rows.count()
    capacities = written(_capacities(spark, n, shards), "shard-capacities")
    rows = written(rows.join(groups, "group"), "shard-linked")
    linked = rows.filter("group_rows > 1")

    cells = linked.groupBy("group", F.pmod(F.xxhash64("id", "row"), F.lit(shards)).cast("int").alias("shard")).agg(
        F.count("*").alias("n"))
    cells = propagate(written(cells, "shard-cells"), capacities, max_rounds)
    # the numbers of a group's members that go to each of its shards: at most one interval for each shard
    before = F.coalesce(F.sum("n").over(W.partitionBy("group").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    dealt = written(cells.withColumn("first", before).groupBy("group").agg(F.collect_list(F.struct(
        "shard", "first", (F.col("first") + F.col("n")).alias("end"))).alias("dealt")), "shard-dealt")
    linked = _numbered(linked, ["group"], ["id", "row"], _bucket(F.col("group_rows"), GROUP_BUCKET_ROWS), "number", "shard-numbered")
    linked = linked.join(dealt, "group", "left").withColumn("shard", F.get(F.filter("dealt", lambda d: (
        d["first"] <= F.col("number")) & (F.col("number") < d["end"])), F.lit(0))["shard"]).drop("number", "dealt")
    linked = written(linked, "shard-placed")

    # one number for each shard: the rows that fill it
    taken = {r.shard: r.n for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    ends, end = [], 0
    for r in sorted(capacities.collect()):
        end += r.capacity - taken.get(r.shard, 0)
        ends.append(end)
    rest = rows.filter("group_rows = 1").unionByName(linked.filter("shard is null").drop("shard"))
    rest = _numbered(rest, [], ["id", "row"], _bucket(n), "number", "shard-rest")
    rest = rest.withColumn("shard", F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e <= F.col("number")))).drop("number")
    placed = linked.filter("shard is not null").unionByName(rest.withColumn("shard", F.col("shard").cast("int")))
    placed = _numbered(placed, ["shard"], ["id", "row"], _bucket(n // shards), "slot", "shard-slots")
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", "group", "group_rows", "shard", "slot")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
