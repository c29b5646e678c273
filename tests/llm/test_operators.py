"""Operators against plain Python versions, round trips and held-out accuracy."""
import random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import brute as B
from llm_tables import SF, docs10  # noqa: F401 - a fixture
from oracle_util import compare

import __spark_entry__ as E
from fleetscope.llm import (byte_bpe, components, decontaminate, language_id, licenses, pii, quality, sharding, simhash,
                            toxicity, warc)

QUERIES, ORACLES = E._llm()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    ok, said = compare(QUERIES[name](spark, SF), SF, ORACLES[name])
    assert ok, said


# -- byte-level BPE ------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def codec():
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))
    return byte_bpe.Codec(byte_bpe.serialise(ranks), public_tokenizers.PATTERN, byte_bpe.newer_characters())


def check_codec(codec, texts):
    tokenizer = B.tokenizer()
    ids, ends = codec.encode(texts)
    data, stops = codec.decode(ids, np.array(ends))
    at = start = 0
    for text, end, stop in zip(texts, ends, stops.tolist()):
        assert ids[at:end].tolist() == (tokenizer.encode_ordinary(text) if text else []), repr(text)
        assert data[start:stop].tobytes() == (text or "").encode()
        at, start = end, stop


def test_every_13th_character_as_the_tiktoken_library(codec):
    chars = [c for c in range(0, 0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 13 == 0)]
    check_codec(codec, [f"a{chr(c)}1{chr(c)}'s  {chr(c)} b" for c in chars])


def test_random_and_long_texts(codec):
    rng = random.Random(1)
    letters = "ab Z'sdtré\n\t _1²5½!,\x1c—中՘ĕ"
    check_codec(codec, ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
                + [None, "", "x" * 50_000, "ab" * 40_000, " " * 5000, "né " * 9000])


def test_a_full_cache_changes_nothing(codec, docs10, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_TOKENS", 50)
    check_codec(codec, docs10.text.tolist()[:60])


def test_decode_is_the_inverse_of_encode(spark, docs10):
    bpe = byte_bpe.Bpe(spark)
    docs = spark.createDataFrame(docs10.head(50)[["doc_id", "text"]])
    got = byte_bpe.decode(byte_bpe.encode(docs, bpe), bpe).toPandas().set_index("doc_id")
    both = byte_bpe.round_trip(docs, bpe).toPandas().set_index("doc_id")
    for i, text in zip(docs10.doc_id[:50], docs10.text):
        assert bytes(got.decoded[i]) == bytes(both.decoded[i]) == text.encode()
        assert list(got.token_ids[i]) == list(both.token_ids[i])


def test_model_refuses_gaps_and_missing_bytes():
    with pytest.raises(ValueError):
        byte_bpe.serialise({b"a": 0, b"b": 2})
    with pytest.raises(ValueError):
        byte_bpe.serialise({b"a": 0, b"b": 1})


def test_op1_equals_tiktoken(spark, docs10):
    tokenizer = B.tokenizer()
    got = {r.doc_id: r for r in QUERIES["op1_byte_bpe"](spark, SF).collect()}
    for i, text in zip(docs10.doc_id, docs10.text):
        ids = tokenizer.encode_ordinary(text)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), B.sha(",".join(map(str, ids))))
        assert got[i].decoded_sha256 == B.sha(text)


# -- language ------------------------------------------------------------------------------------------------------

def test_op2_held_out_accuracy(spark, docs10):
    got = QUERIES["op2_language_id"](spark, SF).toPandas().merge(docs10, on="doc_id")
    held = got[got.held_out]
    assert len(held) > 150 and (held.lang_pred == held.lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_language_families_ties_and_unknown_languages():
    x = np.vstack([language_id.vector(t) for t in ("aaa bbb", "ccc ddd", "eee fff", "ggg hhh")])
    model = language_id.fit(np.repeat(x, 5, axis=0), ["en"] * 5 + ["de"] * 5 + ["fr"] * 5 + ["xx"] * 5)
    assert model.predict(x)[0] == ["en", "de", "fr", "xx"] and model.families == ["germanic", "only xx", "romance"]
    assert language_id.fit(np.zeros((0, 4)), []) is None
    only = language_id.fit(x[:1], ["en"])
    assert only.predict(x)[0] == ["en"] * 4 and only.predict(x)[1].tolist() == [1.0] * 4


def test_vector_counts_whole_texts(monkeypatch):
    text = "Über die Brücke, " * 500
    whole = language_id.vector(text)
    monkeypatch.setattr(language_id, "_RUN", 97)
    assert np.allclose(language_id.vector(text), whole)
    assert not language_id.has_letter("12 ² ½ _!") and language_id.has_letter("1 ² é")


# -- personal data -------------------------------------------------------------------------------------------------

TRICKY = ["x@y.zz_a@b.cc", "000000010.2.3.4 1.2.3.4.5.6.7.8", "+4929348385146306", "4111-1111 1111 1111+1 (980) 555-6268",
          "1" * 30_000, "1 " * 20_000, "a" * 60_000, "x@y.zz " * 4000, "a@" + "b." * 20_000 + "c", "1.2.3.4 \U0001F600" * 2000,
          "+1" + " " * 30_000, "10.0.0.1 4111111111111111 +49 30 123456789 \U0001F600" * 300]


def random_texts(n):
    rng = random.Random(5)
    parts = ["a", "b.", "@", "x@y.zz", "1", "23", "4111 1111 1111 1111", "+1 (980) 555-6268", " ", "-", ".", "10.0.0.1", "é",
             "中", "\U0001F600", "\n", "+", "_", "192.168.1.300", "%", "4929348385146306", "+4929348385146306 "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_base_spans_and_masks(spark, docs10):
    texts = random_texts(800) + TRICKY + docs10.text.tolist()[:300]
    df = spark.createDataFrame(pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    spans = {r.doc_id: r.spans for r in pii.find(df).collect()}
    masks = {r.doc_id: r.text for r in pii.mask(df).collect()}
    base = {k.name for k in pii.BASE}
    for i, text in enumerate(texts):
        want = B.personal(text)
        assert [(s.start, s.kind, s.end) for s in spans[i] if s.kind in base] == [(a, k, b) for a, _, b, k in want], text[:99]
        if len(want) == len(spans[i]):
            assert masks[i] == B.masked(text, want)


def test_added_kinds_need_checksum_or_context(spark):
    cases = {"IBAN DE89 3704 0044 0532 0130 00 here": ["iban"], "GB82WEST12345698765432": ["iban"], "GB83WEST12345698765432": [],
             "my ssn is 123-45-6789": ["ssn"], "the code 123-45-6789": [], "social security: 000-45-6789": []}
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: [s.kind for s in r.spans if s.kind in ("iban", "ssn")] for r in pii.find(df).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
    near, far = (pii.find(spark.createDataFrame([(1, t)], "doc_id long, text string")).first().spans[0].score
                 for t in ("card 4111111111111111", "isbn 4111111111111111"))
    assert near > far


def test_ibans_end_at_the_length_of_their_country(spark):
    numbers = ["ES91 2100 0418 4502 0005 1332", "ES9121000418450200051332", "AT61 1904 3002 3457 3201", "BE68 5390 0754 7034",
               "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"]
    texts = [(f"{before}{x}{after}", x) for x in numbers for before in ("", "AB12 ") for after in (" BIC", " EUR", " BANK", " 1234 X", ".", "")]
    both = "ES91 2100 0418 4502 0005 1332 DE89 3704 0044 0532 0130 00 BIC"
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)] + [(-1, both)], "doc_id int, text string")
    found = {r.doc_id: [r.text[s.start:s.end] for s in r.spans if s.kind == "iban"]
             for r in pii.find(df).join(df, "doc_id").collect()}
    assert found.pop(-1) == [both[:29], both[30:57]]
    assert found == {i: [x] for i, (_, x) in enumerate(texts)}
    masked = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert masked[0] == "<IBAN> BIC" and masked[-1] == "<IBAN> <IBAN> BIC"


# -- quality -------------------------------------------------------------------------------------------------------

def test_measures(spark, docs10):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("a b c # dd é \n \n\n x|y 中".split(" ")) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += ["", None, "a " * 20_000, "a b c d e f g h" * 3, "\x0b\x1ca\x85b"] + docs10.text.tolist()[:200]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit("s"))
    for r in quality.measure(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == B.measured(texts[r.doc_id])


def test_hosts_are_shrunk_and_judged(spark):
    rows = [(h, f) for h, n, bad in (("good", 1000, 20), ("bad", 1000, 900), ("small", 1, 1), (None, 50, 45))
            for f in [True] * bad + [False] * (n - bad)]
    df = spark.createDataFrame(rows, "host string, base_failed boolean")
    got = {r.host: r for r in quality.host_verdicts(df).collect()}
    assert [got[h].host_failed for h in ("good", "bad", None)] == [False, True, True]
    assert got["small"].host_failure_rate < 1  # one document says little
    alike = spark.createDataFrame([("a", True), ("a", False), ("b", True), ("b", False)], "host string, base_failed boolean")
    assert all(abs(r.host_failure_rate - 0.5) < 1e-9 for r in quality.host_verdicts(alike).collect())


# -- toxicity ------------------------------------------------------------------------------------------------------

def test_op7_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op7_toxicity"](spark, sf).toPandas().merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    held = got[got.held_out]
    hit = held.predicted == 1
    assert hit[held.toxic == 1].mean() > 0.85 and (held.toxic[hit] == 1).mean() > 0.75
    rank, n1 = held.score.rank(), (held.toxic == 1).sum()
    assert (rank[held.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(held) - n1)) > 0.93


def test_risk_is_not_negative_and_defined_without_positives():
    rows, cols, values = np.array([0, 1, 2, 3]), np.array([5, 5, 7, 7]), np.ones(4)
    kind = np.array([True, True, False, False])
    model = toxicity.fit(rows, cols, values, kind, 0.3, least=1)
    assert set(model.weights) == {5} and model.weights[5] > 0 and np.isfinite(model.bias)
    none = toxicity.fit(rows, cols, values, np.zeros(4, bool), 0.3)
    assert toxicity.Scorer(none).score("text") == toxicity.Scorer(none).score(None) == 0.0


# -- near duplicates -----------------------------------------------------------------------------------------------

def test_fingerprints(spark, docs10, monkeypatch):
    texts = docs10.text.tolist()[:80] + ["", None, "One", "one TWO", "a b c", "a\x1cb c\x85 d É é", "x y z " * 500]
    want = [B.fingerprint(t) for t in texts]
    assert [simhash.fingerprint(t) for t in texts] == want
    monkeypatch.setattr(simhash, "_RUN", 7)
    assert [simhash.fingerprint(t) for t in texts] == want


@pytest.fixture(scope="module")
def prints():
    """Chains and a dense ball of 512 fingerprints, and random ones."""
    rng = np.random.default_rng(3)
    out = [rng.integers(0, 2 ** 63, 100, dtype=np.uint64)]
    for base in rng.integers(0, 2 ** 63, 12, dtype=np.uint64):
        now = base
        for _ in range(25):
            for k in rng.integers(0, 64, rng.integers(0, 5)):
                now = now ^ (np.uint64(1) << np.uint64(k))
            out.append(np.array([now]))
    out.append(out[0][0] ^ np.arange(512, dtype=np.uint64))
    values = np.unique(np.concatenate([*out, [np.uint64(0), np.uint64(7), np.uint64(2 ** 64 - 1)]]))
    return values, B.components(values.tolist())


@pytest.mark.parametrize("task_rows", [2048, 60, 3])
def test_groups_with_split_tasks(spark, prints, task_rows):
    values, roots = prints
    df = spark.createDataFrame(pd.DataFrame({"doc_id": np.arange(len(values)), "fp": values.view(np.int64)}))
    got = simhash.groups(df, task_rows=task_rows).toPandas()
    place = {v: i for i, v in enumerate(values.view(np.int64).tolist())}
    assert sorted((place[f], c) for f, c in zip(got.fp, got.component_id)) == list(enumerate(roots))


def test_edges_do_not_outnumber_rows(spark, prints):
    """512 fingerprints of one dense ball have thousands of links; each task returns stars."""
    ball = prints[0][0] ^ np.arange(512, dtype=np.uint64)
    df = spark.createDataFrame(pd.DataFrame({"fp": ball.view(np.int64)}))
    assert simhash.links(df).count() < 10 * 512


def test_repeated_values_end_the_walk():
    values = np.array([5, 5, 5, 7], np.uint64)
    pairs = list(simhash.close_pairs(values, np.zeros(4, np.int64), np.zeros(4, np.int32), 3))
    assert {(int(i), int(j)) for a, b in pairs for i, j in zip(a, b)} <= {(0, 3), (1, 3), (2, 3)}


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (None, 3)]
    random.Random(2).shuffle(chain)
    got = components.components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()
    assert {(r.node, r.root) for r in got} == {(i, 0) for i in range(301)} | {(1000 + i, 1000) for i in range(200)}


def test_op8(spark, docs10):
    got = QUERIES["op8_simhash"](spark, SF).toPandas().merge(docs10, on="doc_id")
    prints = [int(f, 16) for f in got.fingerprint]
    roots = B.components(prints)
    least = pd.Series(got.doc_id.values).groupby(roots).transform("min")
    assert (least.values == got.component_id.values).all()


# -- shards --------------------------------------------------------------------------------------------------------

def test_shards_are_even_and_keep_groups(spark):
    rng = random.Random(1)
    texts = ["hot"] * 700 + [f"g{rng.randint(0, 150)}" for _ in range(500)] + [f"u{i}" for i in range(900)] + [None, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sharding.shard(df, shards=12, max_rounds=12).toPandas()
    sizes = got.groupby("shard").size()
    assert len(got) == len(texts) and len(sizes) == 12 and sizes.max() - sizes.min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    cut = got[got.group_rows.between(2, 100)].groupby("group").shard.nunique()
    start = {g: len({hash(i) for i in d.index}) for g, d in got.groupby("group")}  # a hash would cut nearly all
    assert (cut > 1).mean() < 0.1 and len(start) > 100
    assert got[got.group_rows == 700].shard.nunique() <= 8  # at least 4 are needed


def test_all_rows_linked_in_pairs_and_a_group_of_a_third(spark):
    texts = [f"pair {i // 2}" for i in range(4000)] + ["group"] * 2000
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sharding.shard(df, shards=12).toPandas()
    sizes = got.groupby("shard").size()
    assert len(got) == 6000 and list(sizes) == [500] * 12
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    whole = (got[got.group_rows == 2].groupby("group").shard.nunique() == 1).mean()
    assert whole > 0.99, whole
    assert sum(sorted(got[got.group_rows == 2000].shard.value_counts())[-4:]) > 1980  # 4 shards hold 2,000 rows


def test_sharding_is_the_same_again(spark, docs10):
    a, b = (sorted(map(tuple, QUERIES["op9_sharding"](spark, SF).select("doc_id", "shard", "slot").collect())) for _ in range(2))
    assert a == b and len(a) == len(docs10)


# -- decontamination -----------------------------------------------------------------------------------------------

ITEMS = {"1": " ".join(f"w{i}" for i in range(25)), "2": "Short one", "3": "", "4": " ".join(f"w{i}" for i in range(5, 16)),
         "5": "né né né né né né né né né né né"}


@pytest.mark.parametrize("block_words", [10 ** 6, 12])
def test_hits_and_offsets(spark, block_words):
    rng = random.Random(4)
    texts = [None, "", "a short, ONE b", "né " * 30]
    for _ in range(120):
        at = rng.randint(0, 20)
        words = [f"w{i}" for i in range(at, at + rng.randint(3, 30))] + ["short"] * rng.randint(0, 2) + ["one"] * rng.randint(0, 1)
        texts.append(rng.choice(["\U0001F600 ", ""]) + rng.choice([" ", ", ", "--"]).join(words).title())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(list(ITEMS.items()), "item_id string, text string")
    got = {r.doc_id: r for r in decontaminate.scan(docs, items, block_words=block_words).collect()}
    for i, text in enumerate(texts):
        n, places, found = B.hits(text, ITEMS)
        assert (got[i].n_words, got[i]["items"]) == (n, sorted(found)), text
        assert {p for s in got[i].word_spans for p in range(s.first, s.end)} == places
        words = B.WORD.findall((text or "").translate(B.LOWER))
        for w, c in zip(got[i].word_spans, got[i].char_spans):
            assert B.WORD.findall(text[c.first:c.end].translate(B.LOWER)) == words[w.first:w.end]
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, items, block_words=block_words).collect()}
    assert kept == {i for i, text in enumerate(texts) if not B.hits(text, ITEMS)[1]}


# -- revisits and licences -----------------------------------------------------------------------------------------

def test_canonical_urls(spark):
    same = ["http://www.A.example:80/x/?utm_source=f&b=2&a=1#top", "https://a.example/x?a=1&b=2", "https://m.a.example/x/?b=2&a=1"]
    df = spark.createDataFrame([(u,) for u in same + ["https://a.example/X", "", None]], "url string")
    got = [r[0] for r in df.select(warc.canonical_url(F.col("url"))).collect()]
    assert got == ["a.example/x?a=1&b=2"] * 3 + ["a.example/X", "", None]


def test_revisits_against_a_scan(spark):
    """Many captures of one URL over several partitions, ties in time, and every status."""
    rng = random.Random(6)
    rows = []
    for i in range(900):
        url = rng.choice(["http://hot.example/", "http://hot.example/", "http://b.example/x", "http://c.example/y?ref=1"])
        kind = rng.choice(["response", "revisit", "revisit", "other"])
        headers = {"ETag": rng.choice(['"1"', 'W/"1"', '"2"'])} if rng.random() < 0.7 else {}
        if rng.random() < 0.5:
            headers["Last-Modified"] = rng.choice(["mon", "tue"])
        headers |= {"Date": str(i), "Content-Length": str(i)}
        rows.append((f"r{i:04d}", url, rng.randint(0, 300), kind, headers if i % 50 else None))
    df = spark.createDataFrame(rows, "record_id string, url string, ts long, kind string, headers map<string,string>")
    got = {r.record_id: r for r in warc.resolve(df.repartition(7)).collect()}
    asked = [r for r in rows if r[3] == "revisit"]
    assert len(got) == len(asked)
    for rid, url, ts, _, headers in asked:
        found = max(((t, i, h) for i, u, t, k, h in rows if k == "response" and u == url and t <= ts), default=None,
                    key=lambda x: x[:2])
        own = {k.lower(): v for k, v in (headers or {}).items()}
        if found is None:
            want = ("no_response", None, None)
        else:
            stored = {k.lower(): v for k, v in (found[2] or {}).items()}
            by = "etag" if "etag" in own else "last-modified"
            a, b = (h.get(by, "").removeprefix("W/") for h in (own, stored))
            status = "no_validator" if not a or not b else "resolved" if a == b else "mismatch"
            merged = {**stored, **{k: v for k, v in own.items() if k in warc.PERMITTED}}
            want = (status, found[1], merged) if status == "resolved" else (status, None, None)
        assert (got[rid].status, got[rid].response_id, got[rid].headers) == want


def test_nearest_directory_and_prose(spark):
    long = " ".join(["prose"] * 300)
    rows = [(1, "r/LICENSE", "Released under the MIT License."), (2, "r/a/b/c.txt", "x"), (3, "r/a/LICENSE", "All rights reserved."),
            (4, "r/a/own.txt", f"{long}\nLicensed under CC BY-NC 4.0.\n{long}"), (5, "s/x.txt", "x"), (6, None, "x"),
            (7, "t/x.txt", "The driver had a license to drive under the bridge in general, which the public saw."), (8, "ra/x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: (r.licence, r.how, r.from_directory) for r in licenses.scan(df, F.col("path")).collect()}
    assert got == {1: ("MIT", "file", None), 2: ("Proprietary", "inherited", "r/a"), 3: ("Proprietary", "file", None),
                   4: ("CC-BY-NC-4.0", "header", None), 5: (None, "none", None), 6: (None, "none", None),
                   7: (None, "none", None), 8: (None, "none", None)}


@pytest.mark.parametrize("licence", sorted(licenses.TEMPLATES))
def test_every_template_finds_itself(spark, licence):
    if licence == sorted(licenses.TEMPLATES)[0]:  # one job for all
        df = spark.createDataFrame([(k, f"{k}/x", f"Text.\n{t}\n") for k, t in licenses.TEMPLATES.items()], "doc_id string, path string, text string")
        test_every_template_finds_itself.got = {r.doc_id: r.licence for r in licenses.scan(df, F.col("path")).collect()}
    assert test_every_template_finds_itself.got[licence] == licence


# -- pipeline ------------------------------------------------------------------------------------------------------

def test_pipeline_equals_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["pipeline"](spark, sf).collect()}
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    model = toxicity.train(*(spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels")))
    scorer = toxicity.Scorer(model)
    rest = [(i, t) for i, t in zip(docs.doc_id, docs.text) if scorer.score(t) < 0.3]
    roots = B.components([B.fingerprint(t) for _, t in rest])
    least: dict[int, int] = {}
    for (i, _), root in zip(rest, roots):
        least[root] = min(i, least.get(root, i))
    rest = [(i, t) for (i, t), root in zip(rest, roots) if least[root] == i]
    items = pd.read_parquet(f"{sf}/benchmark.parquet")
    windows = set()
    for t in items.text:
        w = B.WORD.findall(t.translate(B.LOWER))
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))}
    tokenizer, want = B.tokenizer(), {}
    for i, text in rest:
        w = B.WORD.findall(text.translate(B.LOWER))
        if not any(tuple(w[k:k + 10]) in windows for k in range(len(w))):
            text = B.masked(text, B.personal(text))
            ids = tokenizer.encode_ordinary(text)
            want[i] = (len(ids), B.sha(",".join(map(str, ids))), B.sha(text))
    assert got == want and 100 < len(want) < len(docs)
