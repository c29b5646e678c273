"""A training-data pipeline over ``documents``: STAGES in order, each one of the operators of ``fleetscope.llm``.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``documents``.

1. toxicity: documents whose score reaches the threshold go;
2. simhash: of each group of near-duplicates one document stays;
3. decontamination: documents in which a passage of the benchmark occurs go;
4. pii: personal data in the texts are replaced by their kind, and n_chars follows;
5. byte_bpe: the texts' token ids and the digests of ids and decoded bytes.

Null and empty texts pass the first four stages (null texts are near-duplicates of empty ones); repeated rows are one
group; an empty table gives an empty table; extra columns are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm import byte_bpe, decontaminate, pii, simhash, toxicity
from fleetscope.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.mask(docs)
    if "n_chars" in masked.columns:  # as long as the text now is
        masked = masked.withColumn("n_chars", F.length("text").cast("long"))
    return masked.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(docs, byte_bpe.Bpe(spark), keep_ids=True)


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("pii", mask_personal_data), ("byte_bpe", encode)]

#: The trained classifier, XXH64 and the tokenizer are beyond SQL; tests/llm compares the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
