"""The conversation trie, hard negatives and MinHash against plain Python versions."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute as B
from llm_tables import SF, docs10  # noqa: F401 - a fixture

from fleetscope.llm import hard_negatives, minhash, prefix_trie


# -- trie ----------------------------------------------------------------------------------------------------------

def closes(bits):
    stack, out = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            out[stack.pop()] = i
    return out


@pytest.mark.parametrize("block", [1, 2, 7, 64])
def test_findclose(block):
    rng = np.random.default_rng(block)
    for n in (1, 2, 9, 200, 3000):
        bits, open_ = [1], 1
        while len(bits) < 2 * n and open_:  # a random tree below one root, then all are closed
            up = open_ < 2 or rng.random() < 0.55
            bits.append(int(up))
            open_ += 1 if up else -1
        bits += [0] * open_
        bits = np.array(bits, np.int8)
        shape = prefix_trie.Parentheses(bits, block)
        want = closes(bits)
        assert shape.findclose(shape.opens).tolist() == [want[i] for i in shape.opens.tolist()]


def random_turns(seed: int, convs: int, hot: int, length: int) -> list[tuple]:
    rng = random.Random(seed)
    turns = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b c", "d\x0be f", "", None]))
             for c in range(convs) for t in range(rng.randint(1, 6))]
    turns += [(c, t, "user", "hot words") for c in range(convs, convs + hot) for t in range(3)]  # copies
    turns += [(20 * convs + 1, t, "user", f"long {t // 3}") for t in range(length)]
    return turns + [(20 * convs + 40, t, "user", f"long {t // 3}") for t in range(length - 1)]


@pytest.mark.parametrize("shard", [1, 40, 1 << 20])
def test_trie_of_many_shards(spark, shard, monkeypatch):
    """Shards of a few conversations: spines are merged over several levels, copies lie in many shards."""
    monkeypatch.setattr(prefix_trie, "_FEWEST", 16)
    turns = random_turns(3, 150, 120, 60)
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = prefix_trie.trie(prefix_trie.rebuilt(df), shard).collect()
    assert sorted(map(tuple, got), key=str) == sorted(B.trie(turns), key=str)


# -- hard negatives ------------------------------------------------------------------------------------------------

def vectors(n: int, dims: int, seed: int) -> list[tuple]:
    """Clusters of different lengths, copies and repeated rows."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, dims)) * rng.uniform(0.3, 2, (12, 1))
    rows = [(i, (centers[i % 12] + rng.normal(size=dims) * 0.15).astype(np.float32).tolist(), int(i % 12 % 5)) for i in range(n)]
    return rows + [(n + i, rows[7][1], i % 3) for i in range(n // 4)] + rows[:5]


@pytest.mark.parametrize("fanout, sample, leaf_rows", [(16, 4096, 4096), (4, 200, 30), (3, 40, 7)])
def test_hard_negatives(spark, fanout, sample, leaf_rows, monkeypatch):
    monkeypatch.setattr(hard_negatives, "QUERY_ROWS", 9)
    rows = vectors(600, 8, 1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(df, F.col("vec_id") % 20 == 0, label=label, fanout=fanout, sample=sample, leaf_rows=leaf_rows)
    want = B.hard_negatives(rows, every=20)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 300


def test_search_leaves_out_cells_but_no_row():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.integers(-300, 300, (1, 6)) + rng.integers(-9, 9, (60, 6)) for _ in range(40)])
    most = int((x * x).sum(axis=1).max())
    tree = hard_negatives.Tree(x[::3], len(x), most, 5, 40)
    assert len(tree.nodes) > 3

    def seen(node, d, cell):
        for j in range(len(node.child)):
            if (cell == j).any():
                node.low[j] = np.minimum(node.low[j], d[cell == j].min(axis=0))
                node.high[j] = np.maximum(node.high[j], d[cell == j].max(axis=0))

    leaf = tree.place(x, seen)
    s = hard_negatives.scores(x[:50], x)
    high = s.max(axis=1)
    low = np.sort(s, axis=1)[:, -60]
    window, found = tree.search(x[:50], low, high)
    visited = set(zip(window.tolist(), found.tolist()))
    inside = {(q, leaf[r]) for q, r in zip(*np.nonzero((s >= low[:, None]) & (s <= high[:, None])))}
    assert inside <= visited and len(visited) < 0.4 * 50 * tree.cells


def test_large_components_are_exact():
    x = np.array([[(1 << 28) - 1, 3], [-(1 << 28) + 7, 11]])
    assert hard_negatives.scores(x, x).tolist() == [[sum(int(a) * int(b) for a, b in zip(u, v)) for v in x.tolist()] for u in x.tolist()]


# -- MinHash -------------------------------------------------------------------------------------------------------

def test_sets_and_estimates():
    rng = random.Random(4)
    make = minhash.Hasher()
    for text in (None, "", " \n", "One", "one TWO", "a b c", "a b c a b c", "É x y z", "w " * 3000):
        assert len(make.shingles(text)) == len(B.shingle_set(text))
    words = [f"w{i}" for i in range(900)]
    errors = []
    for _ in range(60):
        a = rng.sample(words, 400)
        b = list(a)
        for _ in range(rng.randint(0, 40)):
            b[rng.randrange(400)] = rng.choice(words)
        x, y = " ".join(a), " ".join(b)
        p, q = B.shingle_set(x), B.shingle_set(y)
        s, t = (make.signature(make.minima(make.shingles(z))) for z in (x, y))
        lanes = sum((make.minima(make.shingles(x)) & np.uint64(15)) == (make.minima(make.shingles(y)) & np.uint64(15)))
        assert minhash.equal_lanes(s, t) == lanes
        errors.append(minhash.similarity(lanes) - len(p & q) / len(p | q))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08
    assert 100 < minhash.least_equal() < 0.86 * minhash.LANES


def near_copies(n: int, seed: int) -> list[str]:
    """Chains and a group around 85 percent, exact copies, short and empty texts."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(150)]
    out = []
    for _ in range(n):  # all near the base, some linked with it, some only with each other
        own = list(base)
        for _ in range(rng.choice([1, 2, 4, 5, 6, 8])):
            own[rng.randrange(150)] = f"n{rng.randint(0, 10 ** 6)}"
        out.append(" ".join(own))
    chain = [f"c{i}" for i in range(120)]
    for _ in range(n // 3):
        chain[rng.randrange(120)] = f"n{rng.randint(0, 10 ** 6)}"
        out.append(" ".join(chain))
    return out + out[:20] + ["", None, "a b", "A b", "a", "x y z", "X Y\nZ"] + [" ".join(base).upper()] * 3


@pytest.mark.parametrize("chunk", [1024, 12])
def test_components_of_near_copies(spark, chunk):
    texts = near_copies(220, 5)
    random.Random(1).shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, chunk=chunk).collect()}
    sets = [B.shingle_set(t) for t in texts]
    assert got == {i: (len(sets[i]), r, r == i) for i, r in enumerate(B.linked_sets(sets))}


def test_op13(spark, docs10):
    from fleetscope.llm.registry import QUERIES
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op13_minhash"](spark, SF).collect()}
    sets, ids = [B.shingle_set(t) for t in docs10.text], docs10.doc_id.tolist()
    least: dict[int, int] = {}
    roots = B.linked_sets(sets)
    for i, r in zip(ids, roots):
        least[r] = min(i, least.get(r, i))
    assert got == {i: (len(s), least[r]) for i, s, r in zip(ids, sets, roots)}


def test_links_do_not_outnumber_members(spark):
    """300 copies that are all linked with each other: chunks return stars."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base, f"n{i}"])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = minhash.prints(docs).withColumnRenamed("row", "member").cache()
    sets = minhash.full_sets(docs, made).join(made.select("member", "signature"), "member").cache()
    members = made.select(F.lit(1).cast("long").alias("group"), "member")
    assert minhash.links(members, sets, chunk=32).count() < 330
    assert {r.n_shingles for r in made.collect()} == {199} and sets.count() == 300
