"""Queries over vectors, pages, annotated records and review joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmill.functions import text
from docmill.functions.records import as_list, json_array, json_object, kind, semantic_first
from docmill.operators import candidates as cand
from docmill.operators import chunking, review, semantics, vectors
from docmill.plans.catalog import CHUNKS, SQL_BLANK, SQL_LINES, chunks, query, sql_strip, table
from docmill.plans.text_queries import SQL_BLOCK_TYPE
from docmill.schemas import TAXONOMY
from docmill.sources import readers, writers
from docmill.storage import shared_dir


def _queries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    every = table(spark, sf_dir, "embeddings")
    return every, every.where("vec_id % 50 = 0")


_IP = "SELECT q.vec_id AS query_id, x.vec_id AS neighbor_id, x.label AS label, q.label AS query_label, list_inner_product(q.embedding::DOUBLE[], x.embedding::DOUBLE[]) AS score FROM embeddings q JOIN embeddings x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0"
_L2 = _IP.replace("list_inner_product(q.embedding::DOUBLE[], x.embedding::DOUBLE[])", "list_distance(q.embedding::DOUBLE[], x.embedding::DOUBLE[]) ** 2")


@query(f"SELECT query_id, neighbor_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbor_id)::INT AS rank FROM ({_IP}) QUALIFY rank <= 5")
def join02_knn_ip_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, asked = _queries(spark, sf_dir)
    return vectors.nearest(every, asked, 5).withColumn("score", F.round("score", 6))


@query(f"SELECT query_id, neighbor_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score, neighbor_id)::INT AS rank FROM ({_L2}) QUALIFY rank <= 5")
def join02_knn_l2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, asked = _queries(spark, sf_dir)
    return vectors.nearest(every, asked, 5, "l2").withColumn("score", F.round("score", 6))


_TOP40 = f"SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbor_id) AS r FROM ({_IP}) QUALIFY r <= 40"
_FILTERED = f"SELECT query_id, neighbor_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, r)::INT AS rank FROM ({_TOP40}) WHERE label % 3 <> 0 AND score >= 0.1 QUALIFY rank <= 15"


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, asked = _queries(spark, sf_dir)
    found = vectors.with_metadata(vectors.nearest(every, asked, 40), every.select("vec_id", "label"))
    return vectors.eligible_neighbors(found, (F.col("label") % 3 != 0) & (F.col("score") >= 0.1))


@query(_FILTERED)
def fil03_filtered_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(spark, sf_dir).select("query_id", "neighbor_id", "rank")


_FACTS = f"""{CHUNKS}, facts AS (SELECT chunk_idx AS vec_id, language, trust_level, content_type, domain, CASE WHEN chunk_idx % 9 = 1 THEN ['heading'] ELSE ['procedure'] END AS artifact_role FROM chunks)"""


@query(f"""WITH {_FACTS}, q AS (SELECT * FROM embeddings WHERE vec_id % 50 = 0), near AS (
    SELECT q.vec_id AS query_id, e.vec_id AS neighbor_id, list_inner_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS score FROM q JOIN embeddings e ON q.vec_id <> e.vec_id
    QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) DESC, e.vec_id) <= 40)
  SELECT query_id, neighbor_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbor_id)::INT AS rank FROM near JOIN facts f ON f.vec_id = neighbor_id JOIN facts o ON o.vec_id = query_id
  WHERE score >= 0.05 AND f.language IN ('de', 'en', 'fr') AND f.trust_level IN ('high', 'medium', 'low') AND list_has_any(f.content_type, ['paper', 'textbook', 'norm', 'guideline', 'lab_report', 'meeting_notice', 'expert_ppt'])
    AND NOT list_has_any(f.artifact_role, ['heading', 'x']) AND (len(f.domain) = 0 OR len(o.domain) = 0 OR list_has_any(f.domain, o.domain)) QUALIFY rank <= 15""")
def fil03_neighbor_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six rules of neighbours; documents' chunks stand for the vectors' metadata."""
    every, asked = _queries(spark, sf_dir)
    c = F.col
    facts = chunks(spark, sf_dir).select(
        c("chunk_idx").alias("vec_id"), "language", "trust_level", "content_type", "domain", F.when(c("chunk_idx") % 9 == 1, F.array(F.lit("heading"))).otherwise(F.array(F.lit("procedure"))).alias("artifact_role")
    )
    found = vectors.with_metadata(vectors.nearest(every, asked, 40), facts).join(facts.select(c("vec_id").alias("query_id"), c("domain").alias("own_domain")), "query_id")
    rules = vectors.neighbor_rules(True, 0.05, ("de", "en", "fr"), ("high", "medium", "low"), ("paper", "textbook", "norm", "guideline", "lab_report", "meeting_notice", "expert_ppt"), ("heading", "x"))
    return vectors.eligible_neighbors(found, rules).select("query_id", "neighbor_id", "rank")


@query(f"SELECT query_id, ((rank - 1) // 7)::INT AS group_no, string_agg(neighbor_id, ',' ORDER BY rank) AS members FROM ({_FILTERED}) GROUP BY ALL")
def xf07_context_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of ten: the anchor and two locals in each, the neighbours in windows of seven."""
    ranked = _filtered(spark, sf_dir).groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", F.col("neighbor_id").cast("string").alias("id")))).alias("n"))
    base = F.array(F.lit("anchor"), F.lit("before"), F.lit("after"))
    groups = ranked.select("query_id", F.posexplode(vectors.context_groups(base, F.col("n.id"))).alias("group_no", "g"))
    return groups.select("query_id", "group_no", F.array_join(F.slice("g", 4, 7), ",").alias("members"))


@query("SELECT vec_id, round(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm, 1.0::DOUBLE AS unit_norm FROM embeddings")
def mth02_unit_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = vectors.unit(F.transform("embedding", lambda x: x * 3))
    rows = table(spark, sf_dir, "embeddings").withColumn("u", scaled)
    norm = F.sqrt(vectors.inner_product(F.col("embedding"), F.col("embedding")))
    return rows.select("vec_id", F.round(norm, 6).alias("norm"), F.round(F.sqrt(vectors.inner_product(F.col("u"), F.col("u"))), 6).alias("unit_norm"))


@query(f"WITH {CHUNKS} SELECT chunk_id AS key, chunk_idx AS faiss_id FROM chunks UNION ALL SELECT doc_id || '::' || chunk_id, chunk_idx FROM chunks UNION ALL SELECT 'nowhere', NULL")
def join01_resolved_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = chunks(spark, sf_dir)
    index = c.select("chunk_id", F.concat_ws("::", "doc_id", "chunk_id").alias("chunk_uid"), F.col("chunk_idx").alias("faiss_id"))
    names = index.select(F.explode(F.array("chunk_id", "chunk_uid")).alias("key")).unionAll(spark.createDataFrame([("nowhere",)], "key string"))
    return vectors.resolve_ordinals(names, index)


@query("SELECT vec_id AS faiss_id, label, len(embedding) AS dim FROM embeddings")
def snk03_index_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors written as an index with its configuration, and read back with the completeness check."""
    import uuid

    path = f"{shared_dir(spark)}/docmill-{uuid.uuid4().hex}/index"
    rows = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "faiss_id").withColumn("chunk_uid", F.col("faiss_id").cast("string"))
    writers.write_index(rows, path)
    return readers.read_index(spark, path)[0].select("faiss_id", "label", F.size("embedding").cast("long").alias("dim"))


_EDGE = rf"""WITH n AS (SELECT source AS doc, count(*) AS pages FROM documents GROUP BY source), l AS (
  SELECT source AS doc, list_filter(list_transform({SQL_LINES}, lambda x: {sql_strip("x")}), lambda x: x <> '') AS lines FROM documents),
  e AS (SELECT doc, 'header' AS side, unnest(lines[1:3]) AS line FROM l UNION ALL SELECT doc, 'footer', unnest(lines[greatest(1, len(lines) - 2):len(lines)]) FROM l),
  c AS (SELECT doc, side, line, count(*) AS n FROM e GROUP BY ALL),
  f AS (SELECT c.* FROM c JOIN n USING (doc) WHERE pages >= 3 AND c.n >= greatest(2, floor(0.02 * pages)) AND length(line) <= 120)"""


@query(_EDGE + " SELECT doc, side, line, n FROM f")
def xf01_running_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as documents and their rows as pages. Pages here share few lines, so the fraction is 0.02 and not 0.6."""
    return chunking.running_lines(table(spark, sf_dir, "documents"), "source", "doc_id", "text", 0.02)


@query(_EDGE + rf""", d AS (SELECT doc, list(DISTINCT line) AS gone FROM f GROUP BY doc)
  SELECT doc_id, CASE WHEN gone IS NULL THEN text ELSE {sql_strip("array_to_string(list_filter(" + SQL_LINES + ", lambda x: NOT list_contains(gone, " + sql_strip("x") + ")), chr(10))")} END AS text
  FROM documents LEFT JOIN d ON d.doc = documents.source""")
def xf01_cleaned_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.remove_running_lines(table(spark, sf_dir, "documents"), "source", "doc_id", "text", 0.02).select("doc_id", "text")


#: Sentences ``s`` of every line with the line's kind, and their place in the document.
_UNITS = rf"""lines AS (SELECT doc_id, generate_subscripts({SQL_LINES}, 1) AS l, {sql_strip("unnest(" + SQL_LINES + ")")} AS s FROM documents),
  cut AS (SELECT doc_id, l, {SQL_BLOCK_TYPE} AS kind, str_split(regexp_replace(s, '([.!?]){SQL_BLANK}+', '\1' || chr(1), 'g'), chr(1)) AS parts FROM lines WHERE s <> ''),
  pieces AS (SELECT doc_id, l, kind, generate_subscripts(parts, 1) AS p, {sql_strip("unnest(parts)")} AS s FROM cut),
  units AS (SELECT doc_id, kind, s, length(s) AS len, row_number() OVER (PARTITION BY doc_id ORDER BY l, p) AS i FROM pieces WHERE s <> '')"""
#: A step of the recursion gives the chunk of units ``a`` to ``b`` (counted from 1, end exclusive) and what is held after it:
#: units ``first`` to ``following``, or none; ``spent`` says that they are carried over and do not fit beside the next.
#: ``stop`` is the next unit that opens a chunk or stands alone, ``reach`` the first that does not fit.
_CHUNKED = f"""{_UNITS},
  sized AS (SELECT *, sum(len + 1) OVER w AS upto, sum(len + 1) OVER w - len - 1 AS before, kind = 'heading' AS heading, len >= 1200 AS alone, count(*) OVER (PARTITION BY doc_id) + 1 AS n
    FROM units WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
  bounded AS (SELECT x.*, coalesce(y.i, x.n) AS reach, coalesce(min(CASE WHEN x.heading OR x.alone THEN x.i END) OVER (PARTITION BY x.doc_id ORDER BY x.i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), x.n) AS stop
    FROM sized x ASOF LEFT JOIN sized y ON x.doc_id = y.doc_id AND x.before + 1202 <= y.upto),
  d AS (SELECT doc_id, n, list(upto ORDER BY i) AS upto, list(before ORDER BY i) AS before, list(heading ORDER BY i) AS heading, list(alone ORDER BY i) AS alone, list(stop ORDER BY i) AS stop,
    list(reach ORDER BY i) AS reach FROM bounded GROUP BY doc_id, n),
  steps AS (
    SELECT doc_id, 0 AS k, 0::BIGINT AS a, 0::BIGINT AS b, 1::BIGINT AS first, 1::BIGINT AS following, false AS spent FROM d
    UNION ALL
    SELECT doc_id, k + 1, first, e,
      CASE WHEN lone OR spent OR e = n OR heading[e] OR alone[e] THEN e ELSE t END,
      CASE WHEN lone OR e = n THEN e WHEN spent OR heading[e] THEN e + 1 WHEN alone[e] OR (t < e AND upto[e] - before[t] > 1201) THEN e ELSE e + 1 END,
      NOT (lone OR spent OR e = n OR heading[e] OR alone[e]) AND t < e AND upto[e] - before[t] > 1201
    FROM (SELECT *, CASE WHEN upto[e - 1] - before[greatest(first, e - 2)] > 1201 THEN e ELSE greatest(first, e - 2) END AS t FROM (
      SELECT d.*, k, first, following, spent, first = following AND alone[first] AS lone,
        CASE WHEN first = following AND alone[first] THEN first + 1 WHEN spent THEN following
          ELSE greatest(following, first + 1, least(reach[first], coalesce(stop[greatest(following, first + 1)], n))) END AS e
      FROM steps JOIN d USING (doc_id) WHERE first < n))
  ),
  found AS (SELECT s.doc_id, k - 1 AS k, a, b, k > 1 AND a > 0 AND k = max(k) OVER (PARTITION BY s.doc_id) AND upto[b - 1] - before[a] - 1 < 200 AS joined FROM steps s JOIN d USING (doc_id) WHERE k > 0),
  ranges AS (SELECT doc_id, k - joined::INT AS k, joined, a, b FROM found),
  chunks AS (SELECT r.doc_id, r.k, string_agg(s, ' ' ORDER BY joined, i) AS content, list_sort(list(DISTINCT kind)) AS kinds FROM ranges r JOIN units u ON u.doc_id = r.doc_id AND u.i >= r.a AND u.i < r.b GROUP BY r.doc_id, r.k)"""


def _chunks_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.array("text").alias("pages"))
    return chunking.chunk_documents(docs, max_chars=1200, min_chars=200)


@query(f"WITH RECURSIVE {_CHUNKED} SELECT doc_id::VARCHAR AS doc_id, k::INT AS chunk_index, content, 0 AS page_start, 0 AS page_end, array_to_string(kinds, ',') AS block_types FROM chunks")
def xf03_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of every document as one of a single page."""
    return _chunks_of_documents(spark, sf_dir).withColumn("block_types", F.array_join("block_types", ","))


@query(f"""WITH RECURSIVE {_CHUNKED} SELECT doc_id::VARCHAR AS doc_id, printf('%s_c%04d', doc_id::VARCHAR, k) AS chunk_id, doc_id::VARCHAR AS title, content, 0 AS page_start,
  list_contains(kinds, 'heading') AS has_heading, list_contains(kinds, 'table') AS has_table, list_contains(kinds, 'formula') AS has_formula FROM chunks""")
def prj02_chunk_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = _chunks_of_documents(spark, sf_dir).withColumns({"source_path": F.concat(F.lit("a/"), F.col("doc_id"), F.lit(".pdf")), "num_pages": F.lit(1)})
    return chunking.chunk_records(packed).select("doc_id", "chunk_id", "title", "content", "meta.page_start", "meta.has_heading", "meta.has_table", "meta.has_formula")


@query(f"WITH {_UNITS} SELECT d.doc_id, count(s) AS units, coalesce(sum(len), 0) AS chars FROM documents d LEFT JOIN units u USING (doc_id) GROUP BY d.doc_id")
def xf02_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.array("text").alias("pages")).withColumn("u", chunking.units())
    chars = F.aggregate("u", F.lit(0), lambda a, u: a + F.length(u["text"]))
    return rows.select("doc_id", F.size("u").cast("long").alias("units"), chars.cast("long").alias("chars"))


@query("SELECT event_id, CASE WHEN event_id % 3 < 2 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events")
def str07_json_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects alone, in prose, and broken."""
    e = F.col("event_id")
    fence = F.concat(F.lit("Here:\n```json\n"), F.col("props"), F.lit("\n```"))
    answer = F.when(e % 3 == 0, F.col("props")).when(e % 3 == 1, fence).otherwise("{broken")
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(json_object(answer), "$.k", "long").alias("k"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events")
def str08_json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("ok ["), F.col("props"), F.lit("] end"))).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(json_array(answer), "$[0].k", "long").alias("k"))


@query("SELECT event_type, count(*) AS n_lines, count_if(event_id % 5 >= 3) AS n_bad, sum(CASE WHEN event_id % 5 < 3 THEN CAST(json_extract(props, '$.k') AS BIGINT) END) AS k FROM events WHERE event_id % 10 <> 0 GROUP BY event_type")
def src04_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank lines are skipped; broken lines and lines without an object are counted."""
    e = F.col("event_id")
    line = F.when(e % 10 == 0, " ").when(e % 5 == 3, "{broken").when(e % 5 == 4, "[1]").otherwise(F.col("props"))
    rows = readers.parsed_lines(table(spark, sf_dir, "events").select("event_type", line.alias("value")))
    k = F.when(~F.col("bad"), F.try_variant_get("rec", "$.k", "long"))
    return rows.groupBy("event_type").agg(F.count("*").alias("n_lines"), F.count_if("bad").alias("n_bad"), F.sum(k).alias("k"))


@query("""SELECT conv_id, turn, 0 AS place, text AS content FROM conversations WHERE conv_id % 3 < 2 UNION ALL
  SELECT conv_id, turn, 1, text FROM conversations WHERE conv_id % 3 = 1 UNION ALL SELECT conv_id, turn, 0, text FROM conversations WHERE conv_id % 3 = 2""")
def src07_document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chunk, a list of chunks (with an element that is none), and an object with a list of chunks."""
    one = F.struct(F.col("text").alias("content"))
    c = F.col("conv_id") % 3
    body = F.when(c == 0, F.to_json(one)).when(c == 1, F.concat(F.lit("["), F.to_json(one), F.lit(","), F.to_json(one), F.lit(',{"x":1}]'))).otherwise(F.concat(F.lit('{"chunks":['), F.to_json(one), F.lit("]}")))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.parse_json(body).alias("rec"))
    return readers.document_chunks(rows).select("conv_id", "turn", "place", F.try_variant_get("chunk", "$.content", "string").alias("content"))


@query(f"WITH {CHUNKS} SELECT chunk_id, doc_id || '::' || chunk_id AS chunk_uid, language FROM chunks WHERE language <> 'unknown' AND {sql_strip('content')} <> '' AND chunk_idx % 13 <> 0")
def fil01_indexable(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = chunks(spark, sf_dir).withColumn("artifact_role", F.when(F.col("chunk_idx") % 13 == 0, F.array(F.lit("structural"))))
    return readers.indexable(c, exclude_unknown=True).select("chunk_id", F.concat_ws("::", "doc_id", "chunk_id").alias("chunk_uid"), "language")


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'norm' ELSE 'norm,paper' END AS listed, CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'high' ELSE 'low' END AS trust FROM events""")
def prj07_list_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that are absent, scalar or lists; a top-level field goes before the semantic object's."""
    e = F.col("event_id") % 3
    body = F.when(e == 0, '{"trust_level":null,"semantic":{"trust_level":"high"}}').when(e == 1, '{"f":"norm","semantic":{"trust_level":"high"}}').otherwise('{"f":["norm","paper"],"trust_level":"low"}')
    rows = table(spark, sf_dir, "events").select("event_id", F.parse_json(body).alias("rec"))
    return rows.select("event_id", F.array_join(as_list(F.col("rec"), "$.f"), ",").alias("listed"), semantic_first(F.col("rec"), "trust_level").alias("trust"))


@query(f"""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'en' ELSE 'unknown' END AS language, CASE WHEN event_id % 2 = 0 THEN 'paper,norm' ELSE '' END AS content_type,
  CASE WHEN event_id % 2 = 0 THEN 'high' ELSE 'medium' END AS trust_level, CASE WHEN event_id % 2 = 0 THEN 'short' ELSE '' END AS summary_short,
  CASE WHEN event_id % 2 = 0 THEN 2 ELSE 0 END AS n_equations, CASE WHEN event_id % 2 = 0 THEN '3,a' ELSE '' END AS key_quantities FROM events""")
def str09_normalized_semantics(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = '{"language":"en","content_type":["paper","paper","x","norm","textbook"],"trust_level":" high ","summary_short":"  short ","equations":[{"latex":"a"},"b"],"key_quantities":[3,"a"]}'
    bad = '{"language":"fr","content_type":"paper","trust_level":"??","summary_short":7,"equations":{},"key_quantities":null}'
    rows = table(spark, sf_dir, "events").select("event_id", F.parse_json(F.when(F.col("event_id") % 2 == 0, good).otherwise(bad)).alias("raw"))
    f = semantics.normalized_semantics(F.col("raw"))
    return rows.select(
        "event_id", f["language"].alias("language"), F.array_join(f["content_type"], ",").alias("content_type"), f["trust_level"].alias("trust_level"), f["summary_short"].alias("summary_short"),
        F.size(f["equations"]).alias("n_equations"), F.array_join(f["key_quantities"], ",").alias("key_quantities"),
    )


@query(f"""WITH {CHUNKS} SELECT chunk_id, CASE WHEN (has_heading OR has_table OR length({sql_strip("content")}) < 40) AND length(summary_short) < 20 THEN '' ELSE summary_short END AS summary_short FROM chunks""")
def xf06_summary_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return chunks(spark, sf_dir).select("chunk_id", semantics.after_rules(c("summary_short"), c("content"), c("has_heading"), c("has_table")).alias("summary_short"))


@query(f"""WITH {CHUNKS} SELECT chunk_id, concat_ws(',', CASE WHEN len(content_type) = 0 THEN 'content_type' END, CASE WHEN len(domain) = 0 THEN 'domain' END, 'artifact_role') AS empty,
  CASE WHEN (has_heading OR has_table OR length({sql_strip("content")}) < 40) AND length(summary_short) < 20 THEN 'rule4_suppressed' WHEN summary_short = '' THEN 'llm_empty' ELSE 'filled' END AS summary,
  concat_ws(',', CASE WHEN has_heading THEN 'heading' END, CASE WHEN has_table THEN 'table' END) AS roles FROM chunks""")
def xf06_empty_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why fields are empty after the rules, and the roles that headings and tables add where the taxonomy has them."""
    c = F.col
    none = F.array().cast("array<string>")
    short = semantics.after_rules(c("summary_short"), c("content"), c("has_heading"), c("has_table"))
    why = semantics.empty_reasons(c("content_type"), c("domain"), none, c("summary_short"), short, semantics.is_weak(c("content"), c("has_heading"), c("has_table")))
    rows = chunks(spark, sf_dir).select("chunk_id", why.alias("why"), semantics.structural_roles(none, c("has_heading"), c("has_table"), ("heading", "table")).alias("roles"))
    empty = F.concat_ws(",", *[F.when(c(f"why.{f}") == "llm_empty", f) for f in ("content_type", "domain", "artifact_role")])
    return rows.select("chunk_id", empty.alias("empty"), F.coalesce("why.summary_short", F.lit("filled")).alias("summary"), F.array_join("roles", ",").alias("roles"))


@query(f"WITH {CHUNKS} SELECT chunk_id, array_to_string(list_filter(domain, lambda d: list_contains({[*TAXONOMY['domain']]}, d))[1:3], ',') AS domain FROM (SELECT chunk_id, list_distinct_in_order AS domain FROM (SELECT chunk_id, CASE WHEN len(domain) = 2 AND domain[1] = domain[2] THEN domain[1:1] ELSE domain END AS list_distinct_in_order FROM chunks))")
def join08_taxonomy_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = F.concat(F.array(F.lit("nowhere")), F.col("domain"))
    return chunks(spark, sf_dir).select("chunk_id", F.array_join(semantics.allowed_only(mixed, "domain", 3), ",").alias("domain"))


def _listed(field: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in TAXONOMY[field]) + "]"


#: The stand-in model's answers follow from the length and the end of the prompt, which is made again here.
_PROMPT_HEAD = "Classify the chunk. Answer with one JSON object.\n" + "\n".join(f"{field}: {', '.join(ids)}" for field, ids in TAXONOMY.items()) + "\nTitle: "
_ANNOTATED = rf"""WITH t AS (SELECT *, turn % 2 = 0 AS heading, lag(text) OVER w AS before, lead(text, 1) OVER w AS one, lead(text, 2) OVER w AS two, {sql_strip("text")} AS s FROM conversations
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
  m AS (SELECT *, CASE WHEN conv_id % 5 = 0 THEN 'existing' WHEN length(s) < 5 THEN 'structural_rule1_short' WHEN regexp_matches(s, '^[0-9.\- ]+$') THEN 'structural_rule1_numeric'
      WHEN regexp_matches(s, '(?i)^(Figure|Table|Fig\.|Tab\.)\s*\d') THEN 'structural_rule1_label' ELSE 'llm' END AS mode,
    CASE WHEN heading AND length(s) < 80 THEN concat_ws(chr(10) || chr(10), text, nullif({sql_strip("one")}, ''), nullif({sql_strip("two")}, '')) ELSE text END AS read FROM t),
  p AS (SELECT *, '{_PROMPT_HEAD}' || role || chr(10) || 'Before: ' || substr(coalesce({sql_strip("before")}, ''), 1, 1000) || chr(10) || 'After: ' || substr(coalesce({sql_strip("one")}, ''), 1, 1000) || chr(10) || 'Chunk: '
    || substr({sql_strip("read")}, 1, 4000) AS prompt FROM m),
  a AS (SELECT *, length(prompt) AS n, {sql_strip("substr(prompt, greatest(1, length(prompt) - 59))")} AS ending FROM p)
  SELECT conv_id::VARCHAR AS doc_id, turn AS chunk_idx, mode, CASE WHEN mode = 'existing' THEN 'high' WHEN mode = 'llm' THEN {_listed("trust_level")}[n % 3 + 1] ELSE 'medium' END AS trust_level,
    CASE WHEN mode = 'llm' THEN {_listed("language")}[n % 4 + 1] ELSE 'unknown' END AS language,
    CASE WHEN mode = 'llm' AND NOT ((heading OR length(s) < 40) AND length(ending) < 20) THEN ending ELSE '' END AS summary_short, CASE WHEN mode = 'llm' THEN {_listed("content_type")}[n % 16 + 1] ELSE '' END AS content_type FROM a"""


@query(_ANNOTATED)
def udf01_annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents annotated by the stand-in model."""
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("doc_id"), F.col("turn").alias("chunk_idx"), F.col("text").alias("content"), F.col("role").alias("title"),
        (F.col("turn") % 2 == 0).alias("has_heading"), F.lit(False).alias("has_table"), F.when(F.col("conv_id") % 5 == 0, "high").alias("trust_level"),
    )
    return semantics.annotate(rows).select("doc_id", "chunk_idx", "mode", "trust_level", "language", "summary_short", F.array_join("content_type", ",").alias("content_type"))


@query("SELECT d.doc_id, CASE WHEN d.doc_id % 2 = 0 THEN 'preferred' WHEN d.doc_id % 3 = 0 THEN 'fallback' END AS found_in, CASE WHEN d.doc_id % 2 = 0 THEN upper(source) WHEN d.doc_id % 3 = 0 THEN source END AS title FROM documents d")
def join09_chunk_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id"), F.col("text").alias("content"), F.col("source").alias("title"), F.col("lang").alias("source_path"))
    preferred = rows.where("doc_id % 2 = 0").withColumn("title", F.upper("title"))
    return review.chunk_lookup(docs.select("doc_id"), preferred, rows.where("doc_id % 3 = 0"), "doc_id").select("doc_id", "found_in", "title")


@query("""SELECT conv_id AS item, 'a' AS chunk_id, 0 AS place, true AS is_evidence, false AS is_neighbor, false AS is_local, true AS is_context FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL SELECT conv_id, 'b', 1, false, true, false, false FROM (SELECT DISTINCT conv_id FROM conversations) UNION ALL SELECT conv_id, 'c', 2, false, false, true, true FROM (SELECT DISTINCT conv_id FROM conversations)""")
def join10_evidence_badges(spark: SparkSession, sf_dir: str) -> DataFrame:
    def ids(*names: str):
        return F.array(*[F.lit(n) for n in names])

    items = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    items = items.select(F.col("conv_id").alias("id"), ids("a").alias("source_chunks"), ids("b").alias("neighbor_chunk_ids"), ids("c").alias("local_neighbor_chunk_ids"), ids("a", "c").alias("context_chunks"))
    return review.evidence_rows(items)


@query(f"SELECT query_id AS item, (row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, neighbor_id::VARCHAR) - 1)::INT AS place, neighbor_id::VARCHAR AS chunk_id, round(score, 6) AS score FROM ({_TOP40}) QUALIFY place < 15")
def srt04_scored_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, asked = _queries(spark, sf_dir)
    found = vectors.nearest(every, asked, 40).groupBy("query_id").agg(F.collect_list(F.struct(F.col("neighbor_id").cast("string").alias("i"), F.round("score", 6).alias("s"))).alias("n"))
    return review.scored_neighbors(found.select("query_id", F.col("n.i").alias("ids"), F.col("n.s").alias("scores")), "query_id", "ids", "scores")


@query("SELECT source AS file, min(doc_id) AS doc_id FROM documents GROUP BY source")
def src11_file_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("file"), F.col("doc_id").alias("line"))
    return readers.file_documents(rows, F.col("line").cast("string")).select("file", F.col("doc_id").cast("long").alias("doc_id"))


@query("SELECT doc_id, lang FROM documents ORDER BY source, doc_id LIMIT 200")
def lim01_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.limited(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), 200, "source", "doc_id").select("doc_id", "lang")


@query("SELECT d.doc_id, coalesce(CASE WHEN l.toxic = 1 THEN 'low' WHEN l.toxic = 0 THEN 'high' END, 'fresh') AS trust_level FROM documents d LEFT JOIN labels l USING (doc_id)")
def join06_reused_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations of an earlier run are reused; of several for a chunk the last counts."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "low").otherwise("high").alias("known"))
    existing = readers.resolve_union(labels.withColumn("known", F.lit("old")), labels, "doc_id")
    joined = table(spark, sf_dir, "documents").select("doc_id").join(existing, "doc_id", "left")
    return joined.select("doc_id", F.coalesce("known", F.lit("fresh")).alias("trust_level"))


@query("SELECT source, string_agg(DISTINCT lang, ',' ORDER BY lang) AS langs FROM documents GROUP BY source")
def set02_sorted_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"))


@query("SELECT count(*) AS n, count(DISTINCT kind) AS kinds FROM (SELECT lang AS kind FROM documents UNION ALL SELECT role FROM conversations)")
def set01_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "documents").select(F.col("lang").alias("kind")).unionByName(table(spark, sf_dir, "conversations").select(F.col("role").alias("kind")))
    return both.agg(F.count("*").alias("n"), F.count_distinct("kind").alias("kinds"))


@query("""WITH t AS (SELECT conv_id, turn, role, count_if(role = 'user' AND turn % 3 = 0) OVER (PARTITION BY conv_id) AS named FROM conversations)
  SELECT conv_id, string_agg(turn, ',' ORDER BY turn) AS refs FROM t WHERE named = 0 OR (role = 'user' AND turn % 3 = 0) GROUP BY conv_id""")
def join11_evidence_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of the context that are evidence: some of the user's turns and one that is not in the context, or all where none is named."""
    turn = F.col("turn").cast("string")
    named = F.when((F.col("role") == "user") & (F.col("turn") % 3 == 0), turn).otherwise("elsewhere")
    groups = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", turn.alias("id")))).alias("context"), F.collect_list(named).alias("evidence"))
    ids = F.transform("context", lambda c: c["id"])
    kept = F.filter(ids, lambda i: F.array_contains(cand.evidence_ids(F.col("evidence"), ids), i))
    return groups.select("conv_id", F.array_join(kept, ",").alias("refs"))
