"""Benchmark decontamination: one Aho-Corasick automaton over the normalised benchmark items, one scan of each text.

Normalisation: A-Z become lower case; words are the runs of characters other than ASCII characters that are neither
letter nor digit. A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
window. The automaton's letters are word numbers of the benchmark vocabulary (0: a word that no item has), so that a
match is a run of whole words, and its end gives the word positions, which are mapped back to offsets of the original
text.

The automaton goes to the tasks as a broadcast of the items. The number of benchmark words is counted first: beyond
``block_words`` the items are dealt to blocks of about that many words by a hash, the texts are scanned block by block,
and what one block found travels with the rows to the next, so that memory is bounded by one block and no shuffle is
needed.

Defined results: a null or empty text has no words and no hits; null or wordless items have no windows; a null item id is
written as the empty text; items that repeat an id count once; an empty benchmark hits nothing; repeated rows and ids are
each scanned; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm.common import mapped, slices, table, written
from fleetscope.session import ship_package

WINDOW = 10
#: Benchmark words of one automaton: it has at most WINDOW nodes a word.
BLOCK_WORDS = 300_000

#: For each byte of UTF-8: lower case, and a blank for ASCII characters that end a word.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: The same words for Spark's regular expressions.
WORD_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_LETTERS).split() if text else []


class Automaton:
    """Windows of the given (item id, text) pairs."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        import ahocorasick

        self.numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            own = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text))
            for at in range(max(1, len(own) - window + 1) if own else 0):
                found.setdefault(own[at:at + window], set()).add(item)
        self.any = bool(found)
        self.trie = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, ids in found.items():
            self.trie.add_word(key, (len(key), ids))
        if self.any:
            self.trie.make_automaton()

    def scan(self, own: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of word positions (first, end) that windows cover, joined where they meet or overlap, and the items."""
        if not self.any:
            return [], set()
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for last, (length, ids) in self.trie.iter(tuple(map(self.numbers.get, own, repeat(0)))):
            spans.append((last + 1 - length, last + 1))
            items |= ids
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def character_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Offsets in the original text (code points, end exclusive) of spans of word positions."""
    at = [m.span() for m in _WORD.finditer(text)] if spans else []
    return [(at[first][0], at[end - 1][1]) for first, end in spans]


_AUTOMATA: dict[tuple[int, int], Automaton] = {}
_SPANS = "array<struct<first:int,end:int>>"


def scan(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, n_words, word_spans, char_spans, items) of every row of ``docs``: positions of the words that lie in any
    occurrence of a window, the same in characters of the original text, and the ids of the items, sorted."""
    blocks = _blocks(docs.sparkSession, items, item_col, item_text_col, block_words)
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                      F.array().cast(_SPANS).alias("spans"), F.array().cast("array<string>").alias("items"))
    for block, known in enumerate(blocks):
        if block + 1 < len(blocks):
            out = written(out.mapInArrow(_pass(known, window, False),
                                         f"id {kind}, text string, spans {_SPANS}, items array<string>"), "decontaminate")
        else:
            out = out.mapInArrow(_pass(known, window, True), f"id {kind}, n_words int, word_spans {_SPANS}, "
                                                             f"char_spans {_SPANS}, items array<string>")
    return out.withColumnRenamed("id", id_col)


def _blocks(spark: SparkSession, items: DataFrame, item_col: str, text_col: str, block_words: int) -> list[Broadcast]:
    """The items in blocks of about ``block_words`` words, each as a broadcast."""
    ship_package(spark)
    items = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = items.agg(F.sum(F.size(F.split("text", WORD_BREAK)))).first()[0] or 0
    blocks = max(1, -(-n // block_words))
    of = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    return [spark.sparkContext.broadcast([(r.item, r.text) for r in items.filter(of == block).collect()])
            for block in range(blocks)]


def _automaton(known: Broadcast, window: int) -> Automaton:
    """Built once in a worker process, which keeps the last one."""
    key = (hash(tuple(known.value)), window)
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[key] = Automaton(known.value, window)
    return _AUTOMATA[key]


def _pass(known: Broadcast, window: int, last: bool):
    """The scan of one block: adds its spans and items to those that the rows carry."""
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def column(rows: list[list[tuple[int, int]]]) -> pa.Array:
        return pa.array([[{"first": a, "end": b} for a, b in row] for row in rows], spans_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(known, window)
        for part in slices(batches, 1):
            counts, spans, chars, ids = [], [], [], []
            for text, had, found in zip(*(part.column(i).to_pylist() for i in (1, 2, 3))):
                own = words(text)
                here, more = automaton.scan(own)
                spans.append(merged(here + [(s["first"], s["end"]) for s in had]) if had else here)
                ids.append(sorted(more.union(found)) if found else sorted(more))
                counts.append(len(own))
                if last:
                    chars.append(character_spans(text, spans[-1]) if spans[-1] else [])
            items = pa.array(ids, pa.list_(pa.string()))
            if last:
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int32()), column(spans), column(chars), items],
                    names=["id", "n_words", "word_spans", "char_spans", "items"])
            else:
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), column(spans), items],
                                                 names=["id", "text", "spans", "items"])

    return run


def _clean(known: Broadcast, window: int):
    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        automaton = _automaton(known, window)
        return mapped(texts, lambda t: not automaton.scan(words(t))[0], pa.bool_())

    return clean


def digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    hits = F.aggregate("word_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return scan(docs, items).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("word_spans") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the rows in which a window of an item occurs; all columns and rows of the others stay. A filter
    for each block; no join and no shuffle."""
    blocks = _blocks(docs.sparkSession, items, item_col, item_text_col, block_words)
    for block, known in enumerate(blocks):
        docs = docs.filter(_clean(known, window)(F.col(text_col).cast("string")))
        if block + 1 < len(blocks):
            docs = written(docs, "decontaminate")
    return docs


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents),
items AS (
  SELECT cast(item_id AS varchar) AS item, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(words), 10) AS n, array_to_string(list_slice(words, i, i + 9), ' ') AS w
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 8, 2))) AS i FROM items WHERE len(words) > 0) x),
sizes AS (SELECT DISTINCT n FROM windows),
spots AS (
  SELECT rid, i, n, array_to_string(list_slice(words, i, i + n - 1), ' ') AS w
  FROM (SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM docs, sizes WHERE len(words) >= n) x),
hits AS (SELECT rid, i, windows.n, item FROM spots JOIN windows USING (n, w)),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) x GROUP BY rid),
found AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY rid)
SELECT doc_id, cast(len(words) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)
"""
