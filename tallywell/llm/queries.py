"""The driver's queries for the training-data operators: each takes (spark, sf_dir) and applies its operator,
with production parameters, to the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallywell.llm import bpe, matroska, packing, pii, pitman_yor, quality, secrets, set_join, shards, toxicity
from tallywell.llm.common import table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matroska.media_digest(matroska.text_media(table(spark, sf_dir, "documents")))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    rows, _ = shards.sharded(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot", "version")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.tiktoken"))


def op6_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.joined(table(spark, sf_dir, "documents"))


def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.scores(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.spans(table(spark, sf_dir, "documents")))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.spans(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_matroska": op1_matroska,
        "op2_quality": op2_quality,
        "op3_virtual_slots": op3_virtual_slots,
        "op4_toxicity": op4_toxicity,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_set_join": op6_set_join,
        "op7_pitman_yor": op7_pitman_yor,
        "op8_packing": op8_packing,
        "op9_pii": op9_pii,
        "op10_secrets": op10_secrets,
    }


OP6 = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
e AS (SELECT doc_id, unnest(g) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b WHERE 100 * c >= 80 * (len(sa.g) + len(sb.g) - c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS x FROM s UNION SELECT r.doc_id, u.b FROM r JOIN u ON r.x = u.a),
m AS (SELECT doc_id, min(x) AS component_id FROM r GROUP BY doc_id)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id FROM s JOIN m ON s.doc_id = m.doc_id"""


def oracle_sql() -> dict[str, str]:
    """The others need crc32, codecs, tokenizers, models or places of matches, which SQL lacks; tests/llm holds them
    against brute force."""
    return {"op6_set_join": OP6}
