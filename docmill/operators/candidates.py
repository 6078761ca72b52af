"""Question-answer candidates: anchors, budgets, prompts, plans and answers of a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.functions.hashing import candidate_id
from docmill.functions.records import json_array, kind
from docmill.functions.text import has_meta_leak, is_blank, strip

DIFFICULTIES = ("basic", "intermediate", "advanced")
#: What anchors and neighbours must be.
LANGUAGES, TRUST = ("de", "en", "unknown"), ("high", "medium", "low")
ROLES = ("definition", "explanation", "example", "key_result", "exercise")
CONTENT_TYPES = ("textbook", "handbook", "paper", "simulation_report", "api_doc", "software_manual")
LEAST_CHARS = 180


def overlaps(values: Column, allowed: tuple[str, ...]) -> Column:
    """Whether a list shares an element with the allowed ones; no allowed ones means no constraint."""
    if not allowed:
        return F.lit(True)
    return F.coalesce(F.arrays_overlap(values, F.array(*[F.lit(a) for a in allowed])), F.lit(False))


def one_of(value: Column, allowed: tuple[str, ...]) -> Column:
    return F.coalesce(value.isin(*allowed), F.lit(False)) if allowed else F.lit(True)


def one_or_many(df: DataFrame, name: str, allowed: tuple[str, ...]) -> Column:
    """Whether a column of ``df`` is allowed: one value by itself, a list if it shares one with the allowed."""
    return (overlaps if df.schema[name].dataType.typeName() == "array" else one_of)(F.col(name), allowed)


def is_anchor(
    language: Column, trust: Column, roles: Column, types: Column, artifacts: Column | None, content: Column, languages: tuple[str, ...] = LANGUAGES,
    trust_levels: tuple[str, ...] = TRUST, roles_allowed: tuple[str, ...] = ROLES, types_allowed: tuple[str, ...] = CONTENT_TYPES,
    artifacts_excluded: tuple[str, ...] = (), least_chars: int = LEAST_CHARS, trust_is_list: bool = False,
) -> Column:
    """Whether questions are asked about a chunk; a list of trust levels (``trust_is_list``) must share one with the allowed."""
    ok = one_of(language, languages) & (overlaps if trust_is_list else one_of)(trust, trust_levels) & overlaps(roles, roles_allowed) & overlaps(types, types_allowed)
    if artifacts is not None and artifacts_excluded:
        ok = ok & ~overlaps(artifacts, artifacts_excluded)
    return ok & ~is_blank(content) & (F.length(strip(content)) >= least_chars)


def adaptive_caps(chunks: DataFrame, doc: str = "doc_id", content: str = "content", least: int = 20, most: int = 1000, per_100_chunks: float = 40.0, per_100k_chars: float = 4.0) -> DataFrame:
    """Rows ``doc, n_chunks, n_chars, cap``: how many questions a document may give, by its size."""
    sizes = chunks.groupBy(F.col(doc).alias("doc")).agg(F.count("*").alias("n_chunks"), F.coalesce(F.sum(F.length(content)), F.lit(0)).alias("n_chars"))
    wanted = F.bround(F.col("n_chunks") / 100.0 * per_100_chunks + F.col("n_chars") / 100000.0 * per_100k_chars)
    return sizes.withColumn("cap", F.greatest(F.lit(least), F.least(F.lit(most), wanted.cast("int"))))


def within_budget(rows: DataFrame, doc: str, order: list[str], cap: Column) -> DataFrame:
    """The first ``cap`` rows of each document in order."""
    w = Window.partitionBy(doc).orderBy(*order)
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= cap)


def within_question_budget(pairs: DataFrame, doc: str, order: list[str], remaining: Column, limit: int = 0) -> DataFrame:
    """The first questions of each document, as many as ``remaining`` says, and of these the first ``limit`` (0: all) in the
    order of documents. Only ``limit`` numbers of rows meet in one place, a count a document."""
    place = F.row_number().over(Window.partitionBy(doc).orderBy(*order))
    kept = pairs.withColumn("__place", place).where(F.col("__place") <= F.coalesce(remaining, F.lit(2**31 - 1)))
    if limit <= 0:
        return kept.drop("__place")
    counts = kept.groupBy(doc).agg(F.count("*").alias("__n"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy(doc).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return kept.join(before.where(F.col("__before") < limit).select(doc, "__before"), doc).where(F.col("__before") + F.col("__place") <= limit).drop("__place", "__before")


def not_done(rows: DataFrame, done: DataFrame, key: str = "anchor_chunk_id") -> DataFrame:
    """Rows whose key was not handled in an earlier run."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def local_neighbors(order: str, doc: str, value: str, before: int = 1, after: int = 1) -> Column:
    """Array of the neighbours at -1, -2, ... and +1, +2, ... that exist."""
    w = Window.partitionBy(doc).orderBy(order)
    wanted = [F.lag(value, k).over(w) for k in range(1, before + 1)] + [F.lead(value, k).over(w) for k in range(1, after + 1)]
    return F.array_compact(F.array(*wanted)) if wanted else F.array()


def clipped(text: Column, limit: int) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(" …"))).otherwise(text) if limit > 0 else text


def context_text(members: Column, per_chunk: int = 1400, total: int = 22000) -> Column:
    """Text of an array of ``(chunk_id, doc_id, summary, content)``: a header and the summary or content of each.

    Members are taken until the first that would exceed ``total`` characters.
    """

    def header(m: Column, i: Column) -> Column:
        return F.format_string("[Chunk %d | chunk_id=%s | doc_id=%s]", i + 1, m["chunk_id"], m["doc_id"])

    def body(m: Column) -> Column:
        summary = strip(m["summary"])
        return clipped(F.when(F.coalesce(summary, F.lit("")) != "", summary).otherwise(F.coalesce(strip(m["content"]), F.lit(""))), per_chunk)

    blocks = F.transform(members, lambda m, i: F.concat(header(m, i), F.lit("\n"), body(m), F.lit("\n")))
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("used"), F.lit(False).alias("full"))

    def step(acc: Column, block: Column) -> Column:
        over = acc["full"] | (F.lit(total > 0) & (acc["used"] + F.length(block) > total))
        text = F.when(over, acc["text"]).when(acc["used"] == 0, block).otherwise(F.concat(acc["text"], F.lit("\n"), block))
        return F.struct(text.alias("text"), F.when(over, acc["used"]).otherwise(acc["used"] + F.length(block)).alias("used"), over.alias("full"))

    return F.aggregate(blocks, start, step, lambda acc: acc["text"])


def render(template: str, context: Column, max_qa: int, plan: Column | None = None) -> Column:
    """A prompt: the placeholders of the template replaced in order, each literally."""
    out = F.replace(F.lit(template), F.lit("{CONTEXT}"), context)
    out = F.replace(out, F.lit("{MAX_QA_PER_GROUP}"), F.lit(str(max_qa)))
    return F.replace(out, F.lit("{PLAN_JSON}"), plan) if plan is not None else out


def valid_plan(answer: Column) -> Column:
    """The plan in an answer as JSON, the empty plan for ``[]``, null for anything invalid.

    A plan is one object with exactly two takeaways, each with a text and evidence of strings only.
    """
    found = json_array(answer)
    items = F.try_variant_get(found, "$", "array<variant>")
    plan = F.get(items, F.lit(0))
    takeaways = F.try_variant_get(plan, "$.takeaways", "array<variant>")

    def good(t: Column) -> Column:
        text_ok = (kind(t, "$.takeaway") == "STRING") & ~is_blank(F.try_variant_get(t, "$.takeaway", "string"))
        evidence = kind(t, "$.evidence_chunks")
        return F.coalesce(text_ok & evidence.isin("ARRAY<STRING>", "ARRAY<VOID>"), F.lit(False))

    def strings(field: str) -> Column:
        k = kind(plan, f"$.{field}")
        return k.isNull() | k.isin("ARRAY<STRING>", "ARRAY<VOID>", "VOID")

    ok = (F.size(items) == 1) & F.startswith(F.schema_of_variant(plan), F.lit("OBJECT")) & (F.size(takeaways) == 2) & F.forall(takeaways, good)
    ok = ok & strings("equation_quotes") & strings("generator_checks")
    default = '{"equation_quotes":[],"equations_present":false,"generator_checks":[],"takeaways":[]}'
    return F.when(F.size(items) == 0, default).when(F.coalesce(ok, F.lit(False)), F.to_json(plan))


def valid_pair(question: Column, answer: Column, difficulty: Column, drop_leaks: bool = True) -> Column:
    """A question and an answer that are not blank, a known difficulty, and no phrase that gives the excerpt away."""
    ok = ~is_blank(question) & ~is_blank(answer) & F.coalesce(difficulty.isin(*DIFFICULTIES), F.lit(False))
    return ok & ~has_meta_leak(question) & ~has_meta_leak(answer) if drop_leaks else ok


def evidence_ids(evidence: Column, context: Column) -> Column:
    """Evidence that is part of the context, in its order; the whole context if none is."""
    kept = F.filter(F.coalesce(evidence, F.array().cast("array<string>")), lambda e: F.array_contains(context, e))
    return F.when(F.size(kept) == 0, context).otherwise(kept)


def source_ref(chunk_id: Column, doc_id: Column, source_path: Column, title: Column, page_start: Column, page_end: Column) -> Column:
    """What names a chunk's source: six fields, pages null where they are no numbers."""
    return F.struct(
        chunk_id.alias("chunk_id"), doc_id.alias("doc_id"), source_path.alias("source_path"), title.alias("title"),
        page_start.try_cast("int").alias("page_start"), page_end.try_cast("int").alias("page_end"),
    )


def slim_chunk(chunks: DataFrame) -> Column:
    """The eight fields of a chunk that a context needs; what a table lacks is null."""

    def field(name: str) -> Column:
        return F.col(name) if name in chunks.columns else F.lit(None).cast("string")

    meta = [f.name for f in chunks.schema["meta"].dataType.fields] if "meta" in chunks.columns and chunks.schema["meta"].dataType.typeName() == "struct" else []
    pages = [(F.col(f"meta.{p}") if p in meta else F.lit(None)).cast("string").alias(p) for p in ("page_start", "page_end")]
    names = {"chunk_id": "chunk_id", "doc_id": "doc_id", "source_path": "source_path", "title": "title", "summary_short": "summary", "content": "content"}
    return F.struct(*[field(n).alias(alias) for n, alias in names.items()], *pages)


def ref_of(chunk: Column) -> Column:
    """The source ref of a slim chunk."""
    return source_ref(*[chunk[n] for n in ("chunk_id", "doc_id", "source_path", "title", "page_start", "page_end")])


def valid_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.where(valid_pair(F.col("question"), F.col("answer"), F.col("difficulty")))


def candidate_records(pairs: DataFrame) -> DataFrame:
    """Candidate rows of answers (``anchor_chunk_id, anchor_doc_id, context, evidence, question, answer, difficulty, ...``).

    With ``refs`` (the source refs of the context, in its order) the rows name their sources; ``workspace_file`` and
    ``provenance`` are kept where there are any.
    """
    q, a = strip(F.col("question")), strip(F.col("answer"))
    source = evidence_ids(F.col("evidence"), F.col("context"))
    more = []
    if "refs" in pairs.columns:
        more = [
            F.filter("refs", lambda r: F.array_contains(source, r["chunk_id"])).alias("source_refs"), F.col("refs").alias("context_refs"),
            F.array_distinct(F.filter(F.transform("refs", lambda r: r["doc_id"]), lambda d: d.isNotNull())).alias("doc_ids"),
        ]
    more += [F.col(c) for c in ("workspace_file", "provenance") if c in pairs.columns]
    return valid_pairs(pairs).select(
        candidate_id(F.col("anchor_chunk_id"), q, a, F.col("qa_idx")).alias("id"), "anchor_chunk_id", "anchor_doc_id", F.col("context").alias("context_chunks"),
        source.alias("source_chunks"), q.alias("question"), a.alias("answer"), "difficulty", "language", "content_type", "domain", "trust_level", *more,
    )


def answered_pairs(groups: DataFrame, answer: str = "answer_text") -> DataFrame:
    """One row for each object of the model's JSON array, with its place and evidence under any of its names."""
    items = F.try_variant_get(json_array(F.col(answer)), "$", "array<variant>")
    rows = groups.select("*", F.posexplode(items).alias("qa_idx", "item"))

    def text(name: str) -> Column:
        return F.try_variant_get("item", f"$.{name}", "string")

    evidence = F.coalesce(*[F.try_variant_get("item", f"$.{n}", "array<string>") for n in ("evidence_chunks", "source_chunks", "evidence")])
    return rows.select(*groups.columns, "qa_idx", *[text(n).alias(n) for n in ("question", "answer", "difficulty")], evidence.alias("evidence"))
