"""Queries of the two statistics reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.operators import candidates as cand
from docmill.operators import semantics, statistics
from docmill.operators.ordering import first_rows
from docmill.plans.catalog import CANDIDATES, CHUNKS, candidates, chunks, query, table


@query(f"WITH {CHUNKS} SELECT language, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM chunks GROUP BY language")
def agg01_language_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = chunks(spark, sf_dir)
    language = F.coalesce(F.nullif(F.lower(F.trim("language")), F.lit("")), F.lit("unknown"))
    return statistics.counts_with_share(c, language, "language").withColumn("pct", F.round("pct", 6))


@query(f"WITH {CHUNKS} SELECT coalesce(trust_level, 'missing') AS trust_level, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM chunks GROUP BY 1")
def agg01_trust_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.counts_with_share(chunks(spark, sf_dir), F.coalesce("trust_level", F.lit("missing")), "trust_level").withColumn("pct", F.round("pct", 6))


_FIELDS = ["content_type", "domain", "chunk_role", "key_quantities"]


@query(f"WITH {CHUNKS} " + " UNION ALL ".join(f"SELECT '{f}' AS field, count_if(len({f}) > 0 AND chunk_idx % 17 > 0) AS nonempty, count(*) - count_if(len({f}) > 0 AND chunk_idx % 17 > 0) AS empty, count_if(chunk_idx % 17 = 0) AS malformed FROM chunks" for f in _FIELDS))
def agg02_list_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventeenth record counts as one whose fields hold neither lists nor scalars."""
    return statistics.list_fill(chunks(spark, sf_dir), _FIELDS, {f: F.col("chunk_idx") % 17 == 0 for f in _FIELDS})


@query(f"WITH {CHUNKS} SELECT value, count(*) AS n FROM (SELECT unnest(domain) AS value FROM chunks) GROUP BY value ORDER BY n DESC, value LIMIT 15")
def agg03_top_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.top_values(chunks(spark, sf_dir), "domain")


_SUSPECT_SQL = "language = 'unknown' AND len(domain) = 0 AND len(content_type) = 0 AND len(chunk_role) = 0 AND len(key_quantities) = 0 AND length(summary_short) < 10 AND length(content) < 80"


def _suspect() -> F.Column:
    c = {n: F.col(n) for n in ("language", "domain", "content_type", "summary_short", "chunk_role", "key_quantities", "content")}
    return semantics.suspect_structural(c["language"], c["domain"], c["content_type"], c["summary_short"], c["chunk_role"], F.array(), c["key_quantities"], c["content"])


@query(f"""WITH {CHUNKS} SELECT count_if(language = 'unknown') AS unknown, count_if(language = 'unknown' AND len(domain) = 0) AS unknown_no_domain,
  count_if(language = 'unknown' AND len(content_type) = 0) AS unknown_no_type, count_if({_SUSPECT_SQL}) AS suspect FROM chunks""")
def agg04_cross_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    unknown = F.col("language") == "unknown"
    return chunks(spark, sf_dir).agg(
        F.count_if(unknown).alias("unknown"), F.count_if(unknown & (F.size("domain") == 0)).alias("unknown_no_domain"),
        F.count_if(unknown & (F.size("content_type") == 0)).alias("unknown_no_type"), F.count_if(_suspect()).alias("suspect"),
    )


@query(f"""WITH {CHUNKS} SELECT CASE WHEN n < 10 THEN '<10' WHEN n < 40 THEN '10-40' WHEN n < 120 THEN '40-120' ELSE '>=120' END AS bin, count(*) AS chunks,
  count_if(n = 0) AS empty, round(avg(n), 6) AS mean FROM (SELECT length(trim(summary_short, ' ' || chr(10))) AS n FROM chunks) GROUP BY 1""")
def agg05_summary_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length(F.regexp_replace("summary_short", "^[ \n]+|[ \n]+$", ""))
    b = F.when(F.col("n") < 10, "<10").when(F.col("n") < 40, "10-40").when(F.col("n") < 120, "40-120").otherwise(">=120")
    rows = chunks(spark, sf_dir).select(n.alias("n"))
    return rows.groupBy(b.alias("bin")).agg(F.count("*").alias("chunks"), F.count_if(F.col("n") == 0).alias("empty"), F.round(F.avg("n"), 6).alias("mean"))


@query(f"""WITH {CHUNKS} SELECT count_if(len(key_quantities) > 0) AS affected, sum(len(key_quantities)) AS total,
  round(coalesce(sum(len(key_quantities)) / nullif(count_if(len(key_quantities) > 0), 0), 0), 6) AS per_affected FROM chunks""")
def agg07_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.size("key_quantities")
    rows = chunks(spark, sf_dir).agg(F.count_if(size > 0).alias("affected"), F.sum(size).alias("total"))
    return rows.withColumn("per_affected", F.round(F.coalesce(F.try_divide("total", "affected"), F.lit(0.0)), 6))


@query(f"WITH {CHUNKS} SELECT doc_id, language, count_if({_SUSPECT_SQL}) AS suspects, count(*) AS n FROM chunks GROUP BY ALL")
def agg09_suspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks(spark, sf_dir).groupBy("doc_id", "language").agg(F.count_if(_suspect()).alias("suspects"), F.count("*").alias("n"))


@query(f"""WITH {CHUNKS}, r AS (SELECT doc_id AS doc, count(*) AS tot, count_if(language = 'unknown') AS a, count_if(len(domain) = 0) AS b FROM chunks GROUP BY doc_id HAVING count(*) >= 10)
  SELECT doc, tot, 'unknown' AS metric, a AS num, round(a / tot, 6) AS rate FROM r UNION ALL SELECT doc, tot, 'no_domain', b, round(b / tot, 6) FROM r""")
def agg10_document_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = {"unknown": F.col("language") == "unknown", "no_domain": F.size("domain") == 0}
    return statistics.document_rates(chunks(spark, sf_dir), "doc_id", flags, least=10).withColumn("rate", F.round("rate", 6))


@query(f"""WITH {CHUNKS}, r AS (SELECT doc_id AS doc, count(*) AS tot, count_if(language = 'unknown') AS num FROM chunks GROUP BY doc_id)
  SELECT doc, tot, 'unknown' AS metric, num, round(num / tot, 6) AS rate FROM r ORDER BY num / tot DESC, num DESC, tot DESC, doc DESC LIMIT 10""")
def agg10_top_by_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = statistics.document_rates(chunks(spark, sf_dir), "doc_id", {"unknown": F.col("language") == "unknown"})
    return statistics.top_by_rate(rates, "unknown").withColumn("rate", F.round("rate", 6))


@query("""SELECT count_if(event_id % 4 = 0) AS missing, count_if(event_id % 4 = 1) AS malformed, count_if(event_id % 4 > 1) AS objects FROM events""")
def agg11_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Semantic fields that are null, of another type, or objects."""
    e = F.col("event_id")
    wrapped = F.concat(F.lit('{"semantic":'), F.when(e % 4 == 0, "null").when(e % 4 == 1, "[1]").otherwise(F.col("props")), F.lit("}"))
    found = F.schema_of_variant(F.try_variant_get(F.parse_json(wrapped), "$.semantic", "variant"))
    kinds = table(spark, sf_dir, "events").select(F.coalesce(found, F.lit("VOID")).alias("k"))
    is_obj = F.startswith("k", F.lit("OBJECT"))
    return kinds.agg(F.count_if(F.col("k") == "VOID").alias("missing"), F.count_if(~is_obj & (F.col("k") != "VOID")).alias("malformed"), F.count_if(is_obj).alias("objects"))


@query(f"WITH {CANDIDATES} SELECT anchor_doc_id, anchor_chunk_id, count(*) AS qa FROM candidates GROUP BY ALL")
def agg12_qa_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir).groupBy("anchor_doc_id", "anchor_chunk_id").agg(F.count("*").alias("qa"))


@query(f"WITH {CANDIDATES} SELECT anchor_doc_id, count(*) AS qa FROM candidates GROUP BY ALL HAVING count(*) >= 2")
def fil11_least_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir).groupBy("anchor_doc_id").agg(F.count("*").alias("qa")).where("qa >= 2")


@query(f"WITH {CANDIDATES} SELECT anchor_doc_id, difficulty, count(*) AS n FROM candidates GROUP BY ALL")
def agg13_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = statistics.counter_maps(candidates(spark, sf_dir), "anchor_doc_id", "difficulty")
    return maps.select("anchor_doc_id", F.explode("counts").alias("difficulty", "n"))


def _per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))


_RANKED = "WITH c AS (SELECT count(*) AS v FROM {t} GROUP BY {k}), r AS (SELECT v, row_number() OVER (ORDER BY v) AS i, count(*) OVER () AS n, sum(v) OVER () AS total FROM c)"


@query(_RANKED.format(t="events", k="user_id") + " SELECT q, v::DOUBLE AS value FROM r, (SELECT unnest([0.9, 0.95, 0.99])::DOUBLE AS q) WHERE i - 1 = round_even(q * (n - 1), 0)::BIGINT")
def agg14_nearest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.nearest_ranks(_per_user(spark, sf_dir), "n")


@query(_RANKED.format(t="events", k="user_id") + " SELECT count(*) AS n, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean, median(v)::DOUBLE AS median FROM r")
def agg14_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.summary(_per_user(spark, sf_dir), "n").withColumn("mean", F.round("mean", 6))


@query(_RANKED.format(t="orders", k="o_custkey") + " SELECT round(2 * sum(i * v) / (max(n) * max(total)) - (max(n) + 1) / max(n), 6) AS gini FROM r")
def agg15_gini_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return statistics.gini(counts, "n").select(F.round("gini", 6).alias("gini"))


@query(_RANKED.format(t="events", k="user_id") + """ SELECT fraction, round(sum(v) / max(total), 6) AS share FROM r, (SELECT unnest([0.01, 0.05, 0.1, 0.2])::DOUBLE AS fraction)
  WHERE n - i + 1 <= greatest(1, ceil(n * fraction)) GROUP BY fraction""")
def agg16_pareto_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.pareto_shares(_per_user(spark, sf_dir), "n").withColumn("share", F.round("share", 6))


@query(f"WITH {CHUNKS} SELECT chunk_id, language FROM chunks WHERE language = 'unknown' ORDER BY md5('0:' || chunk_id), chunk_id LIMIT 300")
def agg17_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded sample of 300 chunks of unknown language."""
    return statistics.seeded_examples(chunks(spark, sf_dir).where("language = 'unknown'"), "chunk_id").select("chunk_id", "language")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r = 1")
def agg18_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("""SELECT doc_id, text_sha FROM (SELECT doc_id, substr(sha1(regexp_replace(text, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')), 1, 16) AS text_sha FROM documents)
  QUALIFY row_number() OVER (PARTITION BY text_sha ORDER BY doc_id) = 1""")
def agg19_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docmill.functions.hashing import fingerprint

    rows = table(spark, sf_dir, "documents").select("doc_id", fingerprint(F.col("text")).alias("text_sha"))
    return first_rows(rows, ["text_sha"], "doc_id")


@query(f"""WITH {CHUNKS} SELECT doc_id AS doc, count(*) AS n_chunks, sum(length(content)) AS n_chars,
  greatest(20, least(1000, round_even(count(*) / 100.0 * 40.0 + sum(length(content)) / 100000.0 * 4.0, 0)))::INT AS cap FROM chunks GROUP BY doc_id""")
def agg22_adaptive_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cand.adaptive_caps(chunks(spark, sf_dir))


@query(f"WITH {CHUNKS} SELECT count(*) AS n, count(DISTINCT doc_id || '::' || chunk_id) AS n_distinct FROM chunks")
def agg23_unique_uids(spark: SparkSession, sf_dir: str) -> DataFrame:
    uid = F.concat_ws("::", "doc_id", "chunk_id")
    return chunks(spark, sf_dir).agg(F.count("*").alias("n"), F.count_distinct(uid).alias("n_distinct"))


@query("""SELECT conv_id, array_to_string(list(role ORDER BY first_turn), ',') AS roles FROM (SELECT conv_id, role, min(turn) AS first_turn FROM conversations GROUP BY ALL) GROUP BY conv_id""")
def agg25_ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("t"))
    return turns.select("conv_id", F.array_join(F.array_distinct("t.role"), ",").alias("roles"))
