"""Every query on tables with nulls, empty and very long texts, repeats, clashing names, and on empty tables."""
import pytest

import brute as B
from llm_tables import LONG, empty, messy  # noqa: F401 - fixtures

import __spark_entry__ as E

DOCS = 14
QUERIES = E._llm()[0]
PER_DOCUMENT = [q for q in QUERIES if q not in ("op4_warc_revisits", "op11_prefix_trie", "op12_hard_negatives", "pipeline")]


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_fourteen_queries():
    assert len(QUERIES) == 14


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, empty, name):
    df = QUERIES[name](spark, empty)
    assert df.count() == 0 and df.columns


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_a_row_for_every_row(spark, messy, name):
    rows = QUERIES[name](spark, messy).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [(False, i) for i in (1, 2, 3, 4, 4, *range(5, 12))] + [(True, 0)] * 2


def test_op1(spark, messy):
    got = by_id(QUERIES["op1_byte_bpe"](spark, messy))
    assert got[1][0].n_tokens == got[2][0].n_tokens == 0 and got[1][0].ids_sha256 == got[1][0].decoded_sha256 == B.sha("")
    ids = B.tokenizer().encode_ordinary(LONG)
    assert (got[6][0].n_tokens, got[6][0].ids_sha256) == (len(ids), B.sha(",".join(map(str, ids))))
    assert got[6][0].decoded_sha256 == B.sha(LONG) and got[4][0] == got[4][1]


def test_op2(spark, messy):
    got = by_id(QUERIES["op2_language_id"](spark, messy))
    assert {(got[i][0].lang_pred, got[i][0].score) for i in (1, 2, 3, 10)} == {("und", 0.0)}
    assert all(r.lang_pred != "und" and 0 <= r.score <= 1 for i in (4, 5, 6, 11) for r in got[i])


def test_op3(spark, messy):
    got = by_id(QUERIES["op3_license_scan"](spark, messy))
    assert (got[9][0].licence, got[9][0].how) == ("MIT", "file")
    assert {got[i][0].how for i in (5, 6, 7, 8)} == {"inherited"}  # the same directory
    assert {got[i][0].how for i in (1, 2, 4)} == {"none"} and {r.how for r in got[None]} == {"none"}


def test_op4(spark, messy):
    rows = QUERIES["op4_warc_revisits"](spark, messy).collect()
    got = sorted((r.record_id or "", r.status, r.response_id or "") for r in rows)
    assert len(rows) == 6
    assert got.count(("revisit-2", "resolved", "response-2")) == 2
    assert ("revisit-1", "resolved", "response-2") in got  # the later capture has the same body
    assert ("revisit-3", "no_response", "") in got and ("", "no_response", "") in got
    assert ("revisit-5", "resolved", "response-5") in got


def test_op5(spark, messy):
    got = by_id(QUERIES["op5_pii"](spark, messy))
    r = got[8][0]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 0)
    assert r.spans == "email:0:11,ip:23:32,card:34:53" and r.base_sha256 == B.sha(r.spans)
    assert got[1][0].spans == got[2][0].spans == got[6][0].spans == ""
    assert sorted(r.n_phone for r in got[None]) == [0, 1]


def test_op6(spark, messy):
    got = by_id(QUERIES["op6_quality_rules"](spark, messy))
    for i, text in ((1, None), (2, ""), (3, " \t\n\x0b "), (4, "same words in this text " * 9), (6, LONG)):
        r = got[i][0]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == B.measured(text)
    assert got[1][0].base_failed and not got[1][0].kept and got[4][0].base_failed


def test_op7(spark, messy):
    rows = QUERIES["op7_toxicity"](spark, messy).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_op8(spark, messy):
    got = by_id(QUERIES["op8_simhash"](spark, messy))
    assert {got[i][0].fingerprint for i in (1, 2, 3)} == {"0" * 16}
    assert {r.component_id for i in (1, 2, 3) for r in got[i]} == {1}
    assert {r.component_id for i in (4, 5) for r in got[i]} == {4}
    assert sorted(str(r.component_id) for r in got[None]) == ["1", "None"]


def test_op9(spark, messy):
    rows = QUERIES["op9_sharding"](spark, messy).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(i, 0) for i in range(DOCS)]
    assert {r["size"] for r in rows if r.doc_id in (1, 2)} == {8} and {r.law for r in rows} == {"rows"}


def test_op10(spark, messy):
    got = by_id(QUERIES["op10_decontamination"](spark, messy))
    r = got[7][0]
    assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (16, 14, 1, B.sha("1"), True)
    assert (got[1][0].n_words, got[1][0].items_sha256, got[1][0].contaminated) == (0, B.sha(""), False)


def test_op11(spark, messy):
    turns = spark.read.parquet(f"{messy}/conversations.parquet").collect()
    got = sorted(map(tuple, QUERIES["op11_prefix_trie"](spark, messy).collect()), key=str)
    assert got == sorted(B.trie((r.conv_id, r.turn, r.role, r.text) for r in turns), key=str)


def test_op12(spark, messy):
    rows = spark.read.parquet(f"{messy}/embeddings.parquet").collect()
    got = sorted(map(tuple, QUERIES["op12_hard_negatives"](spark, messy).collect()), key=str)
    want = sorted(B.hard_negatives([(r.vec_id, r.embedding, r.label) for r in rows]), key=str)
    assert got == want and {r[0] for r in got} >= {0, 100} and any(r[3] is None for r in got)


def test_op13(spark, messy):
    got = by_id(QUERIES["op13_minhash"](spark, messy))
    assert {(r.n_shingles, r.component_id, r.kept) for i in (1, 2, 3) for r in got[i]} == {(0, i, True) for i in (1, 2, 3)}
    assert {(r.n_shingles, r.component_id) for i in (4, 5) for r in got[i]} == {(5, 4)} and not got[5][0].kept
    assert sorted((r.n_shingles, r.component_id, r.kept) for r in got[None]) == [(0, None, True), (6, None, True)]
    assert got[10][0].n_shingles == 1 and got[10][0].kept


def test_pipeline(spark, messy):
    got = by_id(QUERIES["pipeline"](spark, messy))
    # of 1, 2, 3 and a null row one stays, of 4, 4, 5 one; 7 is contaminated
    assert sorted(got, key=lambda i: (i is None, i)) == [1, 4, 6, 8, 9, 10, 11, None] and all(len(r) == 1 for r in got.values())
    ids = B.tokenizer().encode_ordinary("<EMAIL> 10.0.0.256 <IP>, <CARD>")
    assert got[8][0].token_ids == ids and got[8][0].ids_sha256 == B.sha(",".join(map(str, ids)))


def test_stages_keep_the_columns_of_documents(spark, messy):
    import corpus_pipeline as C
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, docs, messy).schema == docs.schema
