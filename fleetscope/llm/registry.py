"""The queries of this subpackage and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetscope.llm import (byte_bpe, decontaminate, hard_negatives, language_id, licenses, minhash, pii, prefix_trie, quality,
                            sharding, simhash, toxicity, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": byte_bpe.op1,
    "op2_language_id": language_id.op2,
    "op3_license_scan": licenses.op3,
    "op4_warc_revisits": warc.op4,
    "op5_pii": pii.op5,
    "op6_quality_rules": quality.op6,
    "op7_toxicity": toxicity.op7,
    "op8_simhash": simhash.op8,
    "op9_sharding": sharding.op9,
    "op10_decontamination": decontaminate.op10,
    "op11_prefix_trie": prefix_trie.op11,
    "op12_hard_negatives": hard_negatives.op12,
    "op13_minhash": minhash.op13,
}

ORACLES: dict[str, str] = {
    "op3_license_scan": licenses.ORACLE_SQL,
    "op4_warc_revisits": warc.ORACLE_SQL,
    "op6_quality_rules": quality.ORACLE_SQL,
    "op10_decontamination": decontaminate.ORACLE_SQL,
    "op11_prefix_trie": prefix_trie.ORACLE_SQL,
    "op12_hard_negatives": hard_negatives.ORACLE_SQL,
}
