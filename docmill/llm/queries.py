"""Queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from docmill.llm import ann, embedding_dedup, packing, quality, secrets, sentencepiece_codec, sharding, simhash, toxicity, warc
from docmill.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 24)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), width=3, radius=2)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2048)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive_pages(table(spark, sf_dir, "pages"))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_sharding, op2_sentencepiece, op3_simhash, op4_toxicity, op5_embedding_dedup, op6_quality, op7_packing, op8_secrets, op9_warc, op10_ann,
    )
    return {f.__name__: f for f in named} | {"pipeline": corpus_pipeline.run}


#: Exact cosine in double precision between all usable vectors of a label; components by recursion over the links.
OP5_SQL = """
WITH RECURSIVE vecs AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), good AS (
  SELECT vec_id, label, v, sqrt(list_inner_product(v, v)) AS norm FROM vecs
  WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(v, v) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.93
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), classes AS (SELECT a, min(b) AS c FROM reach GROUP BY a), degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.c AS component_id, e.vec_id = c.c AS kept
FROM embeddings e JOIN classes c ON c.a = e.vec_id LEFT JOIN degrees d ON d.a = e.vec_id
"""


def oracle_sql() -> dict[str, str]:
    """Where SQL can express a query; the others are held against brute force in the tests."""
    return {"op5_embedding_dedup": OP5_SQL} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
