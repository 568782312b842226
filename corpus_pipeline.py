"""A training-data pipeline over ``documents``: toxic and poor documents go, near copies go, personal data is
replaced, and what is left is packed into sequences. Each stage reads what the stage before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywell.llm import packing, pii, quality, set_join, toxicity
from tallywell.llm.common import remove, shared_folder, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.ordinary_rows(docs, table(spark, sf_dir, "labels"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_rows(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return set_join.first_of_groups(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxic), ("quality rules", rules), ("n-gram Jaccard join", near_copies), ("PII", private), ("packing", packed)]

#: Compression, language models and tokenizers have no SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written as Parquet in the shared folder and read again. What a stage wrote
    goes once the next one is written; the last one's files stay, as the result reads them."""
    base = shared_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = f"{base}/{k}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        if k:
            remove(spark, f"{base}/{k - 1}")
    return docs
