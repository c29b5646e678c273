"""Test tables; the fixtures are imported by the test modules (a second conftest would hide the first one)."""
import pandas as pd
import pytest

SF = "/root/testdata/sf0.01"
LONG = "wide " * 30_000 + "\n" + "9" * 50_000


@pytest.fixture(scope="session")
def docs10(spark):
    return pd.read_parquet(f"{SF}/documents.parquet")


def write_tables(spark, root, documents, labels, benchmark, pages, conversations=(), embeddings=()):
    """Parquet tables with columns whose names the operators use inside."""
    from pyspark.sql import functions as F
    extra = ["id", "fp", "group", "score", "path", "row", "host", "spans", "shard", "key", "part", "own", "words",
             "member", "q", "windows", "ts", "of", "least"]
    for name, rows, schema in (
            ("documents", documents, "doc_id long, text string, lang string, source string, n_chars long"),
            ("labels", labels, "doc_id long, quality int, toxic int"),
            ("benchmark", benchmark, "item_id long, text string"), ("pages", pages, "page_id long, url string, html string"),
            ("conversations", conversations, "conv_id long, turn long, role string, text string"),
            ("embeddings", embeddings, "vec_id long, embedding array<float>, label int")):
        df = spark.createDataFrame(list(rows), schema)
        df.select("*", *[F.lit("other").alias(c) for c in extra]).repartition(3).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.fixture(scope="session")
def messy(spark, tmp_path_factory):
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    passage = " ".join(f"item{i}" for i in range(14))
    documents = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n\x0b ", "en", "a", 5),
        (4, "same words in this text " * 9, "en", "a", None), (4, "same words in this text " * 9, "en", "a", None),
        (5, "same words in this text " * 9, None, "b", 7), (None, "no id at all, call +49 (30) 1234-5678", "de", None, 9),
        (None, None, None, None, None), (6, LONG, "fr", "b", len(LONG)), (7, f"Before {passage}, after.", "en", "b", 3),
        (8, "x@y.example 10.0.0.256 10.0.0.25, 4111 1111 1111 1111", "en", "b", 3),
        (9, "Released under the MIT License.", "en", "b", 3), (10, "123 456", "es", "a", 1), (11, "Ünïcödé 中文 \U0001F600", None, "a", 1)]
    labels = [(4, 1, 0), (4, 0, 0), (5, None, None), (None, 1, 1), (6, 0, 0), (99, 1, 1)]
    benchmark = [(1, passage), (1, passage), (2, None), (3, ""), (None, "short item"), (4, "?!")]
    pages = [(1, "http://www.A.example/x/?utm_source=f", "one"), (2, "https://a.example/x#top", "one"), (3, None, "two"),
             (None, "http://a.example/x", None), (2, "https://a.example/x#top", "one"), (5, "", "")]
    conversations = [
        (0, 0, "user", "Hi there"), (0, None, "user", "null turn first"), (0, 1, "assistant", None), (0, 1, "assistant", None),
        (1, 0, "user", "own"), (1, 1, None, "own two"), (1, 2, "user", "x " * 40_000), (2, 0, "", ""), (3, 5, "user", "late"),
        (4, 0, "user", "Hi there"), (5, 0, "user", "Hi there"), (23, 0, "user", "no base"), (24, 0, "user", "no base"),
        (None, 0, "user", "no conversation"), (None, None, None, None), (-3, 0, "user", "below zero"), (40, None, None, None)]
    vector = [0.5, -0.25, 0.125]
    embeddings = [
        (0, vector, 1), (100, vector, 1), (100, vector, 1), (7, vector, 0), (1, [0.5, -0.25, 0.0], 1), (2, [0.4, -0.2], 2),
        (3, [0.3, 0.1, 0.1], 2), (3, [0.3, 0.1, 0.1], 2), (None, [0.35, -0.1, 0.1], 3), (4, None, 1), (5, vector, None),
        (6, [float("nan"), 0.0, 0.0], 1), (8, [None, 0.1, 0.1], 1), (9, [float("inf"), 0.0, 0.0], 1), (200, [], 1),
        (11, [1e30, 1.0, 1.0], 4), (300, [0.2, -0.1, 0.3, 0.0], 2), (None, None, None), (12, [-0.5, 0.25, -0.1], 1)]
    return write_tables(spark, tmp_path_factory.mktemp("messy"), documents, labels, benchmark, pages, conversations, embeddings)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return write_tables(spark, tmp_path_factory.mktemp("empty"), [], [], [], [])
