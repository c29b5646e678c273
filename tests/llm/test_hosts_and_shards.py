"""Host verdicts that decide, rows without or with equal ids in shards, many label values, against plain versions."""
import random

from pyspark.sql import functions as F

from fleetscope.llm import language_id, quality, sharding


def prior(counts):
    """Mean, a and b of the beta prior from (documents, failures) of hosts, by moments."""
    n, f = sum(c[0] for c in counts), sum(c[1] for c in counts)
    mean = f / n
    spread = sum(d * (x / d - mean) ** 2 for d, x in counts) / n - mean * (1 - mean) * len(counts) / n
    strength = min(max(mean * (1 - mean) / spread - 1, 1e-3), 10_000) if spread > 0 else 10_000
    return mean, mean * strength, (1 - mean) * strength


def test_a_host_of_repeats_takes_its_good_documents_with_it(spark):
    """Five hosts fail now and then; one repeats itself in a third of its documents and loses them all, a small one none."""
    rng = random.Random(3)
    good = lambda: " ".join(f"w{rng.randint(0, 9999)}" for _ in range(40))
    again, short = "the same eight words stand here once more " * 6, "too short"
    rows = [(f"h{h}", rng.choice([good()] * 30 + [short, again])) for h in range(5) for _ in range(200)]
    rows += [("farm", again if i % 3 == 0 else good()) for i in range(300)] + [("small", again), ("small", good())]
    df = spark.createDataFrame([(i, h, t) for i, (h, t) in enumerate(rows)], "doc_id long, source string, text string")
    got = quality.judge(df).collect()
    assert all(r.kept == (not r.base_failed and r.host != "farm") for r in got)
    assert sum(not r.kept and not r.base_failed for r in got) == 200
    for rule in ("short", "repeated"):
        counts = {}
        for r in got:
            n, f = counts.get(r.host, (0, 0))
            counts[r.host] = n + 1, f + r[rule]
        _, a, b = prior(list(counts.values()))
        for r in got:
            n, f = counts[r.host]
            assert abs(r[f"{rule}_rate"] - (f + a) / (n + a + b)) < 1e-9


def test_rows_without_ids_or_with_one_id_are_many_buckets(spark):
    df = spark.range(0, 9000, 1, 4).select(F.when(F.col("id") % 3 == 0, F.lit(7).cast("long")).when(F.col("id") % 3 == 1, F.col("id"))
                                           .alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 5000).cast("string")).alias("text"))
    buckets = df.withColumns({"id": F.col("doc_id"), "row": F.monotonically_increasing_id()}).withColumn(
        "bucket", sharding._bucket(9000, 512)).groupBy("bucket").count().collect()
    assert len(buckets) == 18 and max(r["count"] for r in buckets) < 700
    got = sharding.shard(df, shards=6).toPandas()
    assert list(got.groupby("shard").size()) == [1500] * 6
    assert all(sorted(g.slot) == list(range(1500)) for _, g in got.groupby("shard"))
    pairs = got[got.group_rows == 2].groupby("group").shard.nunique()
    assert (pairs == 1).mean() > 0.95


def test_more_label_values_than_a_model_may_have(spark):
    rows = [(i, "the house and the garden " * 3, "en") for i in range(60)] + [(100 + i, "das Haus und der Garten " * 3, "de") for i in range(50)]
    rows += [(1000 + i, f"noise {i} words", f"x{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(df, languages=2)
    got = {r.lang_pred for r in language_id.predict(df, model).collect()}
    assert got == {"en", "de"}
