"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import written


def _with_least(pairs: DataFrame, name: str) -> DataFrame:
    """``pairs`` (u, v) with m, the least of u and all its v. The minima are written first, so that both sides of the
    join are plain shuffles and Spark can split a node with very many pairs."""
    least = written(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), name)
    return pairs.join(least, "u")


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, root): for every node of an edge, the least node that can be reached. Loops and repeated edges are
    allowed; edges with a null end are ignored; no edges give no rows. Each round writes its edges to the shared
    folder; the driver only sees their number and a checksum."""
    # each edge once, from the larger to the smaller end
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "cc")
    mark = None
    for _ in range(max_rounds):
        n, check = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if n == 0 or (n, check) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = (n, check)
        # large-star: every larger neighbour of u is linked to the least of u's neighbourhood
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = written(_with_least(both, "cc-least").filter(F.col("v") > F.col("u"))
                        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")
        # small-star: u and its smaller neighbours are linked to the least of them
        small = _with_least(large, "cc-least")
        now = written(small.select("u", F.col("m").alias("v")).unionByName(
            small.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), "cc")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
