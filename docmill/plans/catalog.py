"""Registration of queries, and the tables that stand in for the record stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmill.schemas import TAXONOMY

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the SQL that gives the same rows where there is one."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: White space, and stripping it, as the SQL engine writes it.
SQL_BLANK = r"[\s\x1c-\x1f\x{85}\p{Z}]"


#: Lines of a text at every line boundary, as the SQL engine writes it.
SQL_LINES = r"regexp_split_to_array(coalesce(text, ''), '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]')"


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{SQL_BLANK}+|{SQL_BLANK}+$', '', 'g')"


def _pick(field: str, index: F.Column) -> F.Column:
    return F.get(F.array(*[F.lit(v) for v in TAXONOMY[field]]), index.cast("int"))


def _sql_list(field: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in TAXONOMY[field]) + "]"


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as annotated chunks: the source is the document, doc_id the place in it; labels give the trust level."""
    d, n = F.col("doc_id"), F.col("doc_id")
    none = F.array().cast("array<string>")
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return docs.select(
        F.col("source").alias("doc_id"),
        n.alias("chunk_idx"),
        F.format_string("%s_c%04d", "source", d).alias("chunk_id"),
        F.col("text").alias("content"),
        F.when(d % 9 == 0, "unknown").otherwise(F.col("lang")).alias("language"),
        F.when(F.col("toxic").isNull(), None).when(F.col("toxic") == 1, "low").when(F.col("quality") == 1, "high").otherwise("medium").alias("trust_level"),
        F.when(d % 5 == 0, none).otherwise(F.array(_pick("content_type", d % 16))).alias("content_type"),
        F.when(d % 4 == 0, none).otherwise(F.array(_pick("domain", d % 14), _pick("domain", d % 3))).alias("domain"),
        F.when(d % 6 == 0, none).otherwise(F.array(_pick("chunk_role", d % 6))).alias("chunk_role"),
        F.when(d % 7 == 0, "").otherwise(F.substring(F.col("text"), F.lit(1), (d * 37 % 180).cast("int"))).alias("summary_short"),
        F.when(d % 3 == 0, none).otherwise(F.array(F.col("lang"), F.col("source"))).alias("key_quantities"),
        (F.col("doc_id") % 8 == 0).alias("has_heading"),
        (F.col("doc_id") % 11 == 0).alias("has_table"),
    )


CHUNKS = f"""chunks AS (
  SELECT d.source AS doc_id, d.doc_id AS chunk_idx, printf('%s_c%04d', d.source, d.doc_id) AS chunk_id, d.text AS content,
    CASE WHEN d.doc_id % 9 = 0 THEN 'unknown' ELSE d.lang END AS language,
    CASE WHEN toxic IS NULL THEN NULL WHEN toxic = 1 THEN 'low' WHEN quality = 1 THEN 'high' ELSE 'medium' END AS trust_level,
    CASE WHEN d.doc_id % 5 = 0 THEN []::VARCHAR[] ELSE [{_sql_list("content_type")}[d.doc_id % 16 + 1]] END AS content_type,
    CASE WHEN d.doc_id % 4 = 0 THEN []::VARCHAR[] ELSE [{_sql_list("domain")}[d.doc_id % 14 + 1], {_sql_list("domain")}[d.doc_id % 3 + 1]] END AS domain,
    CASE WHEN d.doc_id % 6 = 0 THEN []::VARCHAR[] ELSE [{_sql_list("chunk_role")}[d.doc_id % 6 + 1]] END AS chunk_role,
    CASE WHEN d.doc_id % 7 = 0 THEN '' ELSE substr(d.text, 1, (d.doc_id * 37 % 180)::INT) END AS summary_short,
    CASE WHEN d.doc_id % 3 = 0 THEN []::VARCHAR[] ELSE [d.lang, d.source] END AS key_quantities,
    d.doc_id % 8 = 0 AS has_heading, d.doc_id % 11 = 0 AS has_table
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the assistant turn that follows as a question-answer candidate of its conversation."""
    conv = table(spark, sf_dir, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    turns = conv.select("conv_id", "turn", "role", F.col("text").alias("question"), F.lead("text").over(w).alias("answer"), F.lead("role").over(w).alias("next_role"))
    rows = turns.where("role = 'user' AND next_role = 'assistant'")
    c, none = F.col("conv_id"), F.array().cast("array<string>")
    return rows.select(
        F.lit("conversations").alias("file"),
        (c * 1000 + F.col("turn")).alias("line"),
        F.when(c % 10 != 0, F.concat(F.lit("cand"), (c * 1000 + F.col("turn")).cast("string"))).alias("id"),
        F.format_string("conv%s_c%04d", c.cast("string"), F.col("turn")).alias("anchor_chunk_id"),
        F.concat(F.lit("conv"), c.cast("string")).alias("anchor_doc_id"),
        "question",
        "answer",
        F.get(F.array(F.lit("basic"), F.lit("intermediate"), F.lit("advanced")), (c % 3).cast("int")).alias("difficulty"),
        F.when(c % 7 == 0, None).when(c % 7 == 1, "fr").otherwise("en").alias("language"),
        F.when(c % 5 == 0, None).when(c % 5 == 1, "low").otherwise("high").alias("trust_level"),
        F.when(c % 4 == 0, none).when(c % 4 == 1, F.array(F.lit("norm"))).otherwise(F.array(F.lit("paper"), F.lit("norm"))).alias("content_type"),
        F.when(c % 3 == 0, none).otherwise(F.array(F.lit("Gas Exchange / 1D"), F.lit("cfd"))).alias("domain"),
        F.when(c % 11 == 0, none).otherwise(F.array(F.concat(F.lit(" conv"), c.cast("string"), F.lit(" ")), F.lit("x"))).alias("source_chunks"),
        F.lit("ws").alias("workspace"),
        F.lit(None).cast("string").alias("topic"),
    )


CANDIDATES = """pairs AS (
  SELECT conv_id, turn, role, text AS question, lead(text) OVER w AS answer, lead(role) OVER w AS next_role FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
), candidates AS (
  SELECT 'conversations' AS file, conv_id * 1000 + turn AS line, CASE WHEN conv_id % 10 <> 0 THEN 'cand' || (conv_id * 1000 + turn) END AS id,
    printf('conv%d_c%04d', conv_id, turn) AS anchor_chunk_id, 'conv' || conv_id AS anchor_doc_id, question, answer,
    ['basic', 'intermediate', 'advanced'][conv_id % 3 + 1] AS difficulty, CASE conv_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'fr' ELSE 'en' END AS language,
    CASE conv_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'low' ELSE 'high' END AS trust_level,
    CASE conv_id % 4 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN ['norm'] ELSE ['paper', 'norm'] END AS content_type,
    CASE WHEN conv_id % 3 = 0 THEN []::VARCHAR[] ELSE ['Gas Exchange / 1D', 'cfd'] END AS domain,
    CASE WHEN conv_id % 11 = 0 THEN []::VARCHAR[] ELSE [' conv' || conv_id || ' ', 'x'] END AS source_chunks, 'ws' AS workspace
  FROM pairs WHERE role = 'user' AND next_role = 'assistant'
)"""
