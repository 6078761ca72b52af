"""Queries of the dataset build and of candidate generation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmill.functions.text import META_LEAKS
from docmill.operators import candidates as cand
from docmill.operators import dataset, semantics
from docmill.plans.catalog import CANDIDATES, CHUNKS, candidates, chunks, query, sql_strip, table

_Q, _A = sql_strip("question"), sql_strip("answer")
REASONS = f"""CASE WHEN {_Q} = '' THEN 'missing_or_empty:question' WHEN {_A} = '' THEN 'missing_or_empty:answer' WHEN length({_Q}) < 20 THEN 'question_too_short'
  WHEN length({_Q}) > 600 THEN 'question_too_long' WHEN length({_A}) < 30 THEN 'answer_too_short' WHEN length({_A}) > 2000 THEN 'answer_too_long'
  WHEN language NOT IN ('de', 'en') THEN 'language_not_allowed' WHEN trust_level NOT IN ('high', 'medium') THEN 'trust_level_not_allowed'
  WHEN len(content_type) > 0 AND NOT list_has_any(content_type, ['textbook', 'handbook', 'paper', 'simulation_report', 'api_doc', 'software_manual']) THEN 'content_type_not_allowed'
  WHEN len(source_chunks) = 0 THEN 'missing_sources' END"""
JUDGED = f"{CANDIDATES}, judged AS (SELECT *, {REASONS} AS reason FROM candidates)"
KEPT = f"""{JUDGED}, kept AS (SELECT * FROM (SELECT *, {_Q} AS instruction, {_A} AS output FROM judged WHERE reason IS NULL)
  QUALIFY row_number() OVER (PARTITION BY instruction, output ORDER BY line) = 1)"""


@query(f"WITH {JUDGED} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM judged GROUP BY 1")
def fil04_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = dataset.judged(candidates(spark, sf_dir))
    return judged.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"WITH {JUDGED} SELECT reason, file, line, id AS candidate_id, anchor_chunk_id FROM judged WHERE reason IS NOT NULL")
def snk06_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.rejects(dataset.judged(candidates(spark, sf_dir)))


@query(f"""WITH {JUDGED} SELECT line, {_Q} AS instruction, {_A} AS output, coalesce(language, 'unknown') AS language, coalesce(trust_level, 'unknown') AS trust_level,
  array_to_string(list_transform(source_chunks, lambda c: 'chunk:' || trim(c)), ',') AS source_ids, CASE WHEN len(domain) > 0 THEN 'gas_exchange_1d' ELSE '' END AS topic FROM judged WHERE reason IS NULL""")
def prj12_instruction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dataset.judged(candidates(spark, sf_dir)).where("reason is null").select("line", *dataset.instruction_columns())
    return kept.select("line", "instruction", "output", "language", "trust_level", F.array_join("source_ids", ",").alias("source_ids"), "topic")


@query(f"WITH {KEPT} SELECT 'ws_' || printf('%05d', row_number() OVER (ORDER BY line)) || '_q1' AS id, line, instruction, output FROM kept")
def prj13_sequential_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.build(candidates(spark, sf_dir)).select("id", "line", "instruction", "output")


@query(f"WITH {KEPT} SELECT coalesce(id, 'ws_' || printf('%05d', row_number() OVER (ORDER BY line)) || '_q1') AS id, line FROM kept")
def prj13_candidate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.build(candidates(spark, sf_dir), strategy="candidate").select("id", "line")


@query(f"""WITH {JUDGED} SELECT count(*) AS n_read, count(DISTINCT CASE WHEN reason IS NULL THEN {_Q} || chr(10) || {_A} END) AS n_kept, count(reason) AS n_dropped,
  count(*) - count(reason) - count(DISTINCT CASE WHEN reason IS NULL THEN {_Q} || chr(10) || {_A} END) AS n_duped FROM judged""")
def agg21_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.counters(dataset.judged(candidates(spark, sf_dir)))


@query(f"""WITH {KEPT} SELECT ('0x' || substr(sha1(anchor_chunk_id), 1, 8))::BIGINT % 4 AS shard, count(*) AS n FROM kept GROUP BY ALL""")
def agg20_sharded_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept samples by the shard they would be mapped in: the global result does not depend on the shards."""
    from docmill.functions.hashing import shard_of

    kept = dataset.deduplicated(dataset.judged(candidates(spark, sf_dir)).where("reason is null").select("file", "line", "id", "question", *dataset.instruction_columns()))
    return kept.groupBy(shard_of(4, F.col("anchor_chunk_id"), F.col("id"), F.col("question")).cast("long").alias("shard")).agg(F.count("*").alias("n"))


@query(f"WITH {KEPT}, ids AS (SELECT 'ws_' || printf('%05d', row_number() OVER (ORDER BY line)) || '_q1' AS id, line FROM kept) SELECT id, line FROM ids WHERE substr(id, 8, 1) <> '7'")
def join07_existing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of an earlier run (here those whose last digit is 7) are not written again."""
    samples = dataset.build(candidates(spark, sf_dir))
    existing = samples.where(F.substring("id", 8, 1) == "7").select("id")
    return samples.join(existing, "id", "left_anti").select("id", "line")


@query(f"WITH {CANDIDATES} SELECT line, anchor_chunk_id FROM candidates WHERE anchor_doc_id NOT IN (SELECT 'conv' || conv_id FROM conversations WHERE conv_id % 3 = 0)")
def join05_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "conversations").where("conv_id % 3 = 0").select(F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("anchor_doc_id"))
    return cand.not_done(candidates(spark, sf_dir), done, "anchor_doc_id").select("line", "anchor_chunk_id")


@query(f"""WITH {CHUNKS} SELECT chunk_id FROM chunks WHERE language IN ('de', 'en', 'unknown') AND trust_level IN ('high', 'medium', 'low')
  AND list_has_any(chunk_role, ['definition', 'explanation', 'example', 'key_result', 'exercise'])
  AND list_has_any(content_type, ['textbook', 'handbook', 'paper', 'simulation_report', 'api_doc', 'software_manual']) AND length({sql_strip("content")}) >= 180""")
def fil02_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return chunks(spark, sf_dir).where(cand.is_anchor(c("language"), c("trust_level"), c("chunk_role"), c("content_type"), None, c("content"))).select("chunk_id")


@query(f"""WITH {CHUNKS}, caps AS (SELECT doc_id, greatest(20, least(1000, round_even(count(*) / 100.0 * 40.0 + sum(length(content)) / 100000.0 * 4.0, 0))) AS cap FROM chunks GROUP BY doc_id)
  SELECT chunk_id, place FROM (SELECT chunk_id, doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY chunk_idx) AS place FROM chunks) c JOIN caps USING (doc_id) WHERE place <= cap""")
def win06_document_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = chunks(spark, sf_dir).select("doc_id", "chunk_id", "chunk_idx", "content")
    caps = cand.adaptive_caps(c).select(F.col("doc").alias("doc_id"), "cap")
    # No cap exceeds 1000, so each document's ranking stops there before the caps are joined.
    first = cand.within_budget(c.drop("content"), "doc_id", ["chunk_idx"], F.lit(1000))
    return first.join(caps, "doc_id").where(F.col("place") <= F.col("cap")).select("chunk_id", "place")


@query("SELECT conv_id, turn, lag(text) OVER w AS prev_text, lead(text) OVER w AS next_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def win01_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lag("text").over(w).alias("prev_text"), F.lead("text").over(w).alias("next_text"))


@query("""SELECT conv_id, turn, array_to_string(list_filter([lag(turn, 1) OVER w, lag(turn, 2) OVER w, lead(turn, 1) OVER w], lambda x: x IS NOT NULL), ',') AS around
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def join04_local_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").withColumn("t", F.col("turn").cast("string"))
    return rows.select("conv_id", "turn", F.array_join(cand.local_neighbors("turn", "conv_id", "t", 2, 1), ",").alias("around"))


@query(rf"""SELECT conv_id, turn, CASE WHEN turn % 2 = 0 AND length({sql_strip("text")}) < 80 THEN concat_ws(chr(10) || chr(10), text, nullif({sql_strip("lead(text, 1) OVER w")}, ''),
  nullif({sql_strip("lead(text, 2) OVER w")}, '')) ELSE text END AS llm_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def win02_heading_lookahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").withColumn("heading", F.col("turn") % 2 == 0)
    return semantics.annotation_text(rows, "conv_id", "turn", "text", "heading").select("conv_id", "turn", "llm_text")


_TURNS = "SELECT conv_id, turn, text, row_number() OVER w AS i FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"
CONTEXT = rf"""WITH t AS ({_TURNS}), b AS (SELECT conv_id, i, '[Chunk ' || i || ' | chunk_id=t' || turn || ' | doc_id=c' || conv_id || ']' || chr(10) ||
    CASE WHEN length({sql_strip("text")}) > 200 THEN substr({sql_strip("text")}, 1, 200) || ' …' ELSE {sql_strip("text")} END || chr(10) AS block FROM t),
  s AS (SELECT *, sum(length(block)) OVER (PARTITION BY conv_id ORDER BY i) AS used FROM b),
  k AS (SELECT *, min(CASE WHEN used > 700 THEN i END) OVER (PARTITION BY conv_id) AS stop FROM s)
  SELECT conv_id, coalesce(string_agg(block, chr(10) ORDER BY i) FILTER (WHERE stop IS NULL OR i < stop), '') AS context FROM k GROUP BY conv_id"""


def _contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    member = F.struct(
        "turn", F.concat(F.lit("t"), F.col("turn").cast("string")).alias("chunk_id"), F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("doc_id"),
        F.lit(None).cast("string").alias("summary"), F.col("text").alias("content"),
    )
    groups = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(member)).alias("members"))
    return groups.select("conv_id", cand.context_text(F.col("members"), 200, 700).alias("context"))


@query(CONTEXT)
def win07_context_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contexts(spark, sf_dir)


@query(f"SELECT conv_id, 'Write 2 questions.' || chr(10) || context || chr(10) || 'Plan: [\"{{MAX}}\"]' AS prompt FROM ({CONTEXT})")
def prj16_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = "Write {MAX_QA_PER_GROUP} questions.\n{CONTEXT}\nPlan: {PLAN_JSON}"
    return _contexts(spark, sf_dir).select("conv_id", cand.render(template, F.col("context"), 2, F.lit('["{MAX}"]')).alias("prompt"))


_LEAKY = " OR ".join(f"contains(lower(question), '{p}') OR contains(lower(answer), '{p}')" for p in META_LEAKS)


@query(f"""WITH {CANDIDATES} SELECT line, difficulty FROM candidates WHERE {_Q} <> '' AND {_A} <> '' AND NOT ({_LEAKY})""")
def fil08_valid_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates(spark, sf_dir)
    return rows.where(cand.valid_pair(F.col("question"), F.col("answer"), F.col("difficulty"))).select("line", "difficulty")


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{"equation_quotes":[],"equations_present":false,"generator_checks":[],"takeaways":[]}'
  WHEN 1 THEN '{"takeaways":[{"evidence_chunks":["a"],"takeaway":"x"},{"evidence_chunks":[],"takeaway":"y"}]}' END AS plan FROM events""")
def fil09_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty plans, a good plan inside prose, a plan of one takeaway, and no array at all."""
    e = F.col("event_id")
    good = 'Sure: [{"takeaways":[{"takeaway":"x","evidence_chunks":["a"]},{"takeaway":"y","evidence_chunks":[]}]}] done'
    answer = F.when(e % 4 == 0, "[]").when(e % 4 == 1, good).when(e % 4 == 2, '[{"takeaways":[{"takeaway":"x","evidence_chunks":[]}]}]').otherwise("{}")
    return table(spark, sf_dir, "events").select("event_id", cand.valid_plan(answer).alias("plan"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'b' ELSE 'a,b' END AS evidence FROM events""")
def fil10_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.when(F.col("event_id") % 3 == 0, F.array(F.lit("b"), F.lit("x"))).otherwise(F.array(F.lit("x")))
    context = F.array(F.lit("a"), F.lit("b"))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(cand.evidence_ids(found, context), ",").alias("evidence"))


@query(rf"""WITH {CHUNKS} SELECT chunk_id, 'What is chunk ' || chunk_id || ' about?' AS question, chunk_id AS source_chunk FROM chunks""")
def prj11_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a stand-in model, parsed out of prose and assembled into candidate records."""
    c = chunks(spark, sf_dir)
    pair = F.struct(F.concat(F.lit("What is chunk "), F.col("chunk_id"), F.lit(" about?")).alias("question"), F.lit("About a tool.").alias("answer"), F.lit("basic").alias("difficulty"), F.array("chunk_id").alias("evidence"))
    groups = c.select(
        F.col("chunk_id").alias("anchor_chunk_id"), F.col("doc_id").alias("anchor_doc_id"), F.array("chunk_id").alias("context"), "language", "content_type", "domain", "trust_level",
        F.concat(F.lit("Answer: "), F.to_json(F.array(pair, F.struct(F.lit(" ").alias("question"), F.lit("x").alias("answer"), F.lit("basic").alias("difficulty"), F.array("chunk_id").alias("evidence"))))).alias("answer_text"),
    )
    made = cand.candidate_records(cand.answered_pairs(groups))
    return made.select(F.col("anchor_chunk_id").alias("chunk_id"), "question", F.get("source_chunks", F.lit(0)).alias("source_chunk"))


_REF = "chunk_id || '|' || doc_id || '|' || coalesce(p, '') || '|' || coalesce(t, '')"


@query(f"""WITH {CHUNKS}, refs AS (SELECT *, CASE WHEN chunk_idx % 2 = 0 THEN (chunk_idx % 50)::VARCHAR END AS p, CASE WHEN chunk_idx % 3 > 0 THEN 'title ' || chunk_idx END AS t FROM chunks),
  w AS (SELECT chunk_id, lag({_REF}) OVER w AS before, {_REF} AS own, doc_id, chunk_idx, lag(chunk_id) OVER w AS prev FROM refs WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_idx))
  SELECT chunk_id AS anchor_chunk_id, concat_ws(';', own, before) AS context_refs, CASE WHEN chunk_idx % 4 = 0 AND prev IS NOT NULL THEN before ELSE concat_ws(';', own, before) END AS source_refs, doc_id AS doc_ids FROM w""")
def prj05_source_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate records over contexts of an anchor and the chunk before it: the sources named by the evidence, and by the context."""
    c, i = F.col, F.col("chunk_idx")
    rows = chunks(spark, sf_dir).withColumns({
        "source_path": F.concat(F.lit("a/"), "doc_id"), "title": F.when(i % 3 > 0, F.concat(F.lit("title "), i.cast("string"))),
        "meta": F.struct(F.when(i % 2 == 0, (i % 50).cast("string")).otherwise("no page").alias("page_start"), F.lit(None).cast("string").alias("page_end")),
    })
    w = Window.partitionBy("doc_id").orderBy("chunk_idx")
    both = rows.withColumn("slim", cand.slim_chunk(rows)).withColumn("members", F.array_compact(F.array("slim", F.lag("slim").over(w))))
    ids = F.transform("members", lambda m: m["chunk_id"])
    pairs = both.select(
        c("chunk_id").alias("anchor_chunk_id"), c("doc_id").alias("anchor_doc_id"), ids.alias("context"), F.transform("members", cand.ref_of).alias("refs"), "language", "content_type", "domain", "trust_level",
        F.lit("What is it about?").alias("question"), F.lit("About a tool.").alias("answer"), F.lit("basic").alias("difficulty"), F.lit(0).alias("qa_idx"),
        F.when(i % 4 == 0, F.array(F.get(ids, F.lit(1)))).alias("evidence"),
    )

    def text(refs: str):
        empty = F.lit("")
        return F.array_join(F.transform(refs, lambda r: F.concat_ws("|", r["chunk_id"], r["doc_id"], F.coalesce(r["page_start"].cast("string"), empty), F.coalesce(r["title"], empty))), ";")

    made = cand.candidate_records(pairs)
    return made.select("anchor_chunk_id", text("context_refs").alias("context_refs"), text("source_refs").alias("source_refs"), F.array_join("doc_ids", ",").alias("doc_ids"))


@query(f"""WITH {CANDIDATES}, placed AS (SELECT line, anchor_doc_id, row_number() OVER (PARTITION BY anchor_doc_id ORDER BY line) AS place FROM candidates)
  SELECT line FROM placed WHERE place <= 1 + length(anchor_doc_id) % 3 ORDER BY anchor_doc_id, place LIMIT 500""")
def win06_question_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first questions of each document, as many as it may give, and of these the first 500 in the order of documents."""
    rows = candidates(spark, sf_dir).select("line", "anchor_doc_id")
    return cand.within_question_budget(rows, "anchor_doc_id", ["line"], 1 + F.length("anchor_doc_id") % 3, 500).select("line")


@query("""WITH s AS (SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 0 ELSE 1 END AS ok FROM conversations) SELECT conv_id, turn FROM s WHERE ok = 1""")
def fil13_valid_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intermediate samples without an output, with one that is no string, that are no object, and whole ones."""
    c = F.col("conv_id") % 4
    body = F.when(c == 0, '{"instruction":"x"}').when(c == 1, '{"instruction":"x","output":3}').when(c == 2, '["instruction","output"]').otherwise(F.to_json(F.struct(F.col("text").alias("instruction"), F.lit("y").alias("output"))))
    return table(spark, sf_dir, "conversations").where(dataset.valid_sample(F.parse_json(body))).select("conv_id", "turn")
