"""Queries of the text and id functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions import hashing, text
from docmill.functions.records import record_text
from docmill.operators import statistics
from docmill.plans.catalog import CANDIDATES, CHUNKS, candidates, chunks, query, sql_strip, table

#: Decimal places of measured numbers, equal in both engines.
PLACES = 6


def _rounded(x: F.Column) -> F.Column:
    """Rounded as the SQL engine does, on the scaled number: Spark's own rounding takes the decimal digits, which differs at halves."""
    return F.round(x * 10.0**PLACES) / 10.0**PLACES


@query(r"""SELECT lang, count(*) AS docs, count_if(length(text) = 0) AS empty,
  round(avg(length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) / length(text)), 6) AS alnum_ratio,
  round(avg(length(regexp_replace(text, '[^\s\x1c-\x1f\x{85}\p{Z}]', '', 'g')) / length(text)), 6) AS whitespace_ratio,
  round(avg(length(regexp_replace(text, '[\x00-\x7f]', '', 'g')) / length(text)), 6) AS non_ascii_ratio,
  round(avg(length(text)), 6) AS mean, round(median(length(text)), 6) AS median,
  round(quantile_cont(length(text), 0.9), 6) AS p90, round(quantile_cont(length(text), 0.99), 6) AS p99 FROM documents GROUP BY lang""")
def str10_text_quality_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A language with an empty text has no mean ratios (not a number). Null texts count as documents only; where all are null the rest is null."""
    measured = table(spark, sf_dir, "documents").select("lang", *[c.alias(k) for k, c in text.ratios(F.col("text"), sql=True).items()])
    means = [_rounded(F.avg(k)).alias(k) for k in ("alnum_ratio", "whitespace_ratio", "non_ascii_ratio")]
    return measured.groupBy("lang").agg(
        F.count("*").alias("docs"), F.sum((F.col("len_chars") == 0).cast("long")).alias("empty"), *means, _rounded(F.avg("len_chars")).alias("mean"),
        _rounded(F.median("len_chars")).alias("median"), _rounded(F.percentile("len_chars", 0.9)).alias("p90"), _rounded(F.percentile("len_chars", 0.99)).alias("p99"),
    )


@query(rf"""WITH lines AS (SELECT doc_id, {sql_strip("unnest(str_split(text, chr(10)))")} AS line FROM documents), cut AS (
  SELECT doc_id, unnest(str_split(regexp_replace(line, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) AS s FROM lines)
  SELECT doc_id, count_if({sql_strip("s")} <> '') AS sentences FROM cut GROUP BY doc_id""")
def str01_sentence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_line = F.transform(F.split("text", "\n"), lambda line: F.size(text.sentences(line)))
    return table(spark, sf_dir, "documents").select("doc_id", F.aggregate(per_line, F.lit(0), lambda a, n: a + n).cast("long").alias("sentences"))


#: Kind of a stripped line ``s``.
SQL_BLOCK_TYPE = r"""CASE
    WHEN length(s) < 80 AND (regexp_matches(s, '^\d+(\.\d+)*\s+\S+') OR regexp_matches(s, '(?i)^(chapter|section|kapitel|abschnitt)\b') OR (
      length(regexp_replace(s, '[^\p{L}]', '', 'g')) >= 3 AND length(regexp_replace(s, '[^\p{L}]', '', 'g')) = length(regexp_replace(s, '[^\p{Lu}]', '', 'g')))) THEN 'heading'
    WHEN contains(s, '|') OR regexp_matches(s, '\S+\s{2,}\S+\s{2,}\S+') THEN 'table'
    WHEN (regexp_matches(s, '[=±+−∑∫√∞≡≤≥≈≠⋅∙°∆∂λμσπφθ^/]') AND regexp_matches(s, '\p{L}')) OR regexp_matches(s, '(?i)\b(eq\.?|equation)\b') THEN 'formula'
    ELSE 'paragraph' END"""


@query(rf"""WITH lines AS (SELECT lang, {sql_strip("unnest(str_split(text, chr(10)))")} AS s FROM documents), typed AS (
  SELECT lang, {SQL_BLOCK_TYPE} AS block_type FROM lines WHERE s <> '')
  SELECT lang, block_type, count(*) AS n FROM typed GROUP BY ALL""")
def str02_block_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("lang", F.explode(F.split("text", "\n")).alias("line")).where(~text.is_blank(F.col("line")))
    return lines.select("lang", text.block_type(F.col("line")).alias("block_type")).groupBy("lang", "block_type").agg(F.count("*").alias("n"))


@query(rf"""SELECT page_id, substr(regexp_replace(regexp_replace(lower({sql_strip("url")}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 40) AS slug FROM pages""")
def str05_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.slug(F.col("url")).alias("slug"))


@query(r"""WITH m AS (SELECT lang, length(lower(text)) - length(regexp_replace(lower(text), '[äöüß]', '', 'g')) AS umlauts,
    len(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), lambda w: w IN ('the','and','or','of','to','in','for','with','is','are'))) AS en,
    len(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), lambda w: w IN ('der','die','das','und','oder','mit','für','ist','sind'))) AS de FROM documents)
  SELECT lang, CASE WHEN umlauts >= 2 OR de > en + 2 THEN 'de' WHEN en > de + 2 THEN 'en' ELSE 'unknown' END AS detected, count(*) AS n FROM m GROUP BY ALL""")
def str06_lang_detect_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("lang", text.detect_language(F.col("text")).alias("detected")).agg(F.count("*").alias("n"))


@query(r"""WITH p AS (SELECT page_id, regexp_replace(regexp_replace(url, '^https?://', ''), '\.[^./]*$', '') AS bare FROM pages)
  SELECT page_id, 'pdf_' || replace(bare, '/', '__') || '_' || substr(sha1(bare), 1, 8) AS doc_id FROM p""")
def prj01_document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace("url", "^https?://", "")
    return table(spark, sf_dir, "pages").select("page_id", hashing.document_id(path).alias("doc_id"))


@query(f"WITH {CHUNKS} SELECT chunk_id, regexp_extract(chunk_id, '(?s)^(.*)_c', 1) AS doc_id, coalesce(nullif(summary_short, '') || chr(10) || chr(10) || content, content) AS embed_text FROM chunks")
def prj04_embed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = chunks(spark, sf_dir)
    return c.select("chunk_id", text.chunk_document(F.col("chunk_id")).alias("doc_id"), text.embed_text(F.col("summary_short"), F.col("content"), F.lit("")).alias("embed_text"))


@query(f"WITH {CHUNKS} SELECT chunk_id, coalesce(nullif({sql_strip('summary_short')}, ''), nullif({sql_strip('language')}, '')) AS first_text, doc_id || '::' || chunk_id AS chunk_uid FROM chunks")
def prj08_first_nonblank(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = chunks(spark, sf_dir)
    return c.select("chunk_id", text.first_nonblank(F.col("summary_short"), F.col("language")).alias("first_text"), F.concat_ws("::", "doc_id", "chunk_id").alias("chunk_uid"))


@query(f"SELECT conv_id, turn, CASE WHEN {sql_strip('text')} = '' THEN '' ELSE text END AS found FROM conversations")
def prj09_record_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts under other names and inside other objects are found all the same."""
    rows = table(spark, sf_dir, "conversations")
    body = F.to_json(F.struct(F.lit("  ").alias("text"), F.col("text").alias("body")))
    nested = F.to_json(F.struct(F.struct(F.col("text").alias("md")).alias("payload"), F.lit(3).alias("content")))
    return rows.select("conv_id", "turn", record_text(F.parse_json(F.when(F.col("conv_id") % 2 == 0, body).otherwise(nested))).alias("found"))


@query(rf"""WITH {CANDIDATES} SELECT line, anchor_chunk_id || ':' || substr(sha1('{{"a":' || to_json(answer) || ',"i":0,"q":' || to_json(question) || '}}'), 1, 16) AS candidate_id,
  substr(sha1({sql_strip("question")} || chr(10) || {sql_strip("answer")}), 1, 16) AS fp, 'ws_' || substr(sha1(anchor_chunk_id || chr(10) || question || chr(10) || answer), 1, 16) || '_q1' AS hash_id FROM candidates""")
def prj14_ids_and_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, a, anchor = F.col("question"), F.col("answer"), F.col("anchor_chunk_id")
    return candidates(spark, sf_dir).select(
        "line", hashing.candidate_id(anchor, q, a, F.lit(0)).alias("candidate_id"), hashing.fingerprint(q, a).alias("fp"), hashing.hash_id("ws", anchor, q, a).alias("hash_id")
    )


@query(f"WITH {CANDIDATES} SELECT (('0x' || substr(sha1(anchor_chunk_id), 1, 8))::BIGINT % 16)::INT AS shard, count(*) AS n FROM candidates GROUP BY ALL")
def fil14_shard_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    shard = hashing.shard_of(16, F.col("anchor_chunk_id"), F.col("id"), F.col("question"))
    return candidates(spark, sf_dir).groupBy(shard.alias("shard")).agg(F.count("*").alias("n"))


_LEAKS = " OR ".join(f"contains(lower(text), '{p}')" for p in text.META_LEAKS)


@query(f"SELECT lang, count_if({_LEAKS}) AS leaks, count(*) AS n FROM documents GROUP BY lang")
def fil05_meta_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.count_if(text.has_meta_leak(F.col("text"))).alias("leaks"), F.count("*").alias("n"))


@query(rf"""WITH lines AS (SELECT {sql_strip("unnest(str_split(text, chr(10)))")} AS s FROM documents)
  SELECT CASE WHEN length(s) < 5 THEN 'structural_rule1_short' WHEN regexp_matches(s, '^[0-9.\- ]+$') THEN 'structural_rule1_numeric'
    WHEN regexp_matches(s, '(?i)^(Figure|Table|Fig\.|Tab\.)\s*\d') THEN 'structural_rule1_label' ELSE 'llm' END AS mode, count(*) AS n FROM lines GROUP BY ALL""")
def fil07_structural_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy(F.coalesce(text.structural_mode(F.col("line")), F.lit("llm")).alias("mode")).agg(F.count("*").alias("n"))


@query(f"""WITH {CANDIDATES} SELECT line, printf('%04d', line) || ' | ' || anchor_chunk_id || ' | ' || substr(question, 1, 90) || CASE WHEN length(question) > 90 THEN '…' ELSE '' END AS label FROM candidates""")
def prj19_question_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir).select("line", text.question_label(F.col("line"), F.col("anchor_chunk_id"), F.col("question")).alias("label"))


@query("""SELECT doc_id, source || CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN ' — p. ' || (doc_id % 50 + 1) ELSE ' — p. ' || (doc_id % 50 + 1) || '–' || (doc_id % 50 + 3) END AS label FROM documents""")
def prj20_source_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    start = F.when(d % 3 != 0, d % 50)
    end = F.when(d % 3 == 2, d % 50 + 2).when(d % 3 == 1, d % 50)
    path = F.concat(F.lit("a/b/"), F.col("source"), F.lit(".pdf"))
    return table(spark, sf_dir, "documents").select("doc_id", text.source_label(F.lit(None).cast("string"), path, start, end).alias("label"))


@query("SELECT conv_id, sum(len(str_split(replace(text, chr(13), ''), chr(10)))) AS n_lines FROM conversations GROUP BY conv_id")
def str12_unix_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = F.regexp_replace("text", "\n", "\r\n")
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sum(F.size(F.split(text.unix_lines(windows), "\n"))).alias("n_lines"))


@query("SELECT round(avg(length(text)), 6) AS mean, median(length(text))::DOUBLE AS median, round(quantile_cont(length(text), 0.9), 6) AS p90, round(quantile_cont(length(text), 0.99), 6) AS p99 FROM documents")
def agg06_length_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = table(spark, sf_dir, "documents").agg(*statistics.length_percentiles(F.length("text")))
    return out.select(*[F.round(c, PLACES).alias(c) for c in out.columns])
