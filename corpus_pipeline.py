"""The corpus pipeline: documents to packed sequences in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a table that is written
and read again as the next one's docs. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm import packing, quality, secrets, simhash, toxicity
from docmill.llm.common import drop_stored, scratch, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`") for c in COLUMNS])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents predicted toxic (score of 0.7 or more); null texts are scored as empty."""
    return toxicity.reject_toxic(_documents(docs), table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents predicted poor (score below 0.3)."""
    return quality.reject_poor(_documents(docs), table(spark, sf_dir, "labels"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates (sets of five-word shingles similar by 0.8 or more) the row with the smallest id.

    Documents with a null id belong to no class and stay; of rows with the same smallest id and text one stays, and
    unlike texts under one id are judged each by its own class.
    """
    docs = _documents(docs)
    classes = simhash.near_duplicate_classes(docs, width=5, similarity=0.8)
    row = ["doc_id", "text_hash"]
    first = classes.where("doc_id = class_id and text_hash = class_hash").select(*row).distinct()
    marked = docs.where("doc_id is not null").withColumn("text_hash", simhash.text_hash("text"))
    kept = _documents(marked.join(first, row, "left_semi").dropDuplicates(row))
    return _documents(kept.unionByName(docs.where("doc_id is null")))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced by its kind in brackets, and n_chars fits the new text."""
    return secrets.redact_documents(_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and place in it."""
    return packing.pack_documents(_documents(docs), public_tokenizers.path("byte_bpe_50k.json"), 2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", keep_one_copy),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Trained models, hashing and tokenising are not expressible in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each written to the shared folder before the next reads it.

    What a stage stored on its way goes when its result is written, and that result when the next stage's is. Nulls, empty and
    very long texts, repeated rows and empty tables are what the stages make of them; an empty table gives no pieces.
    """
    docs, held = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            docs = keep(stored(stage(spark, docs, sf_dir), name))
        if held is not None:
            drop_stored(spark, held)
        held = docs
    return STAGES[-1][1](spark, docs, sf_dir)
