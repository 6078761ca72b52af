"""The pipeline's stages as whole jobs: each reads a folder and writes a folder."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, replace
from datetime import UTC, datetime

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.config import DEFAULT_PROMPTS, Generation, Prompts
from docmill.functions.hashing import document_id
from docmill.functions.records import as_list, kind, record_text, semantic_first, text_field
from docmill.functions.text import embed_text, first_nonblank, is_blank, ratios
from docmill.operators import candidates as cand
from docmill.operators import chunking, dataset, semantics, statistics, vectors
from docmill.operators.ordering import number_rows
from docmill.schemas import CANDIDATE, CANDIDATE_RECORD, NORMALIZED
from docmill.sources import readers, writers
from docmill.storage import stored

Backend = Callable[[], Callable[[str], str | None]]


__all__ = ["Generation", "annotate", "build_dataset", "chunk_report", "embed", "generate_candidates", "hash_encoder", "ingest", "qa_report", "replace", "retrieve"]


def _now() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


def ingest(spark: SparkSession, input_dir: str, output_dir: str, suffix: str = ".pdf", parse: Callable[[bytes], list[str]] = readers.text_pages, max_chars: int = 6000, min_chars: int = 400, overlap: int = 2) -> DataFrame:
    """Documents of a folder to normalised chunk records; documents that cannot be parsed are returned with their error."""
    root = input_dir.rstrip("/") + "/"
    parsed = stored(readers.pages_of(readers.read_files(spark, input_dir, suffix), parse), "parsed")
    rel = F.substring_index(F.col("path"), root, -1)
    docs = parsed.where("error is null").select(document_id(rel).alias("doc_id"), rel.alias("source_path"), "pages")
    long = docs.select("doc_id", "source_path", F.size("pages").alias("num_pages"), F.posexplode("pages").alias("page_idx", "text"))
    clean = chunking.remove_running_lines(long)
    member = F.sort_array(F.collect_list(F.struct("page_idx", "text")))
    pages = clean.groupBy("doc_id", "source_path", "num_pages").agg(member.alias("p")).select("doc_id", "source_path", "num_pages", F.col("p.text").alias("pages"))
    packed = chunking.chunk_documents(pages, max_chars=max_chars, min_chars=min_chars, overlap=overlap).join(pages.drop("pages"), "doc_id")
    writers.write_jsonl(chunking.chunk_records(packed), output_dir, cluster_by=("doc_id", "chunk_id"))
    return parsed.where("error is not null").select("path", "error")


def annotate(spark: SparkSession, input_dir: str, output_dir: str, backend: Backend = lambda: semantics.stub_backend, files: int = 0, shards: int = 1, shard: int = 0, taxonomy_dir: str | None = None) -> None:
    """Normalised chunks to annotated ones; chunks that an earlier run annotated in ``output_dir`` keep what they have.

    Neighbours and headings look over all chunks, those that are done included. The new table is written beside the old one
    and then takes its place, so a run may be stopped at any time. ``files`` limits the files read, in the order of their
    names, and ``shards`` and ``shard`` choose some of them. ``taxonomy_dir`` holds the taxonomies with their labels; without
    it the built-in ids hold.
    """
    writers.recover(spark, output_dir)
    chunks = spark.read.schema(NORMALIZED).json(input_dir).select("*", F.col("_metadata.file_path").alias("file"))
    chunks = readers.file_shard(readers.first_files(chunks, files), shards, shard).drop("file")
    order = F.regexp_extract("chunk_id", r"_c(\d+)$", 1).cast("long")
    rows = chunks.select("*", order.alias("chunk_idx"), F.coalesce("meta.has_heading", F.lit(False)).alias("has_heading"), F.coalesce("meta.has_table", F.lit(False)).alias("has_table"))
    earlier = readers.exists(spark, output_dir)
    if earlier:
        done = spark.read.schema("chunk_id STRING, trust_level STRING").json(output_dir).where("trust_level is not null")
        known = rows.join(done.groupBy("chunk_id").agg(F.first("trust_level").alias("trust_level")), "chunk_id", "left")
    else:
        known = rows.withColumn("trust_level", F.lit(None).cast("string"))
    taxonomy = readers.taxonomies(spark, taxonomy_dir) if taxonomy_dir else semantics.PLAIN
    made = semantics.annotate(known, backend, taxonomy).where("mode <> 'existing'").withColumn("language", F.coalesce("language", F.lit("unknown")))
    if earlier:
        made = made.unionByName(spark.read.schema(made.schema).json(output_dir).where("trust_level is not null"))
    writers.replace_jsonl(stored(made, "annotated"), output_dir)


def hash_encoder(dim: int = 64) -> Callable[[list[str]], np.ndarray]:
    """A stand-in for an embedding model: signed word hashes."""

    def encode(texts: list[str]) -> np.ndarray:
        import zlib

        out = np.zeros((len(texts), dim))
        for k, text in enumerate(texts):
            for word in text.lower().split():
                h = zlib.crc32(word.encode())
                out[k, h % dim] += 1 if h >> 31 else -1
        return out

    return encode


def embed(
    spark: SparkSession, semantic_dir: str, index_dir: str, make_encoder: Callable[[], Callable[[list[str]], np.ndarray]] = hash_encoder, exclude_unknown: bool = False, normalize: bool = True,
    limit: int = 0, batch_size: int = 64, model: str = "",
) -> dict:
    """Eligible chunks of JSON lines and JSON files of any shape to an index of vectors with their metadata, numbered in document order."""
    rec = F.col("chunk")
    lists = {f: F.when(kind(rec, f"$.semantic.{f}").isNotNull(), as_list(rec, f"$.semantic.{f}")).otherwise(as_list(rec, f"$.{f}")) for f in ("content_type", "domain", "artifact_role")}
    chunks = readers.read_documents(spark, semantic_dir).select(
        text_field(rec, "$.doc_id").alias("doc_id"), text_field(rec, "$.chunk_id").alias("chunk_id"), first_nonblank(text_field(rec, "$.source_path"), F.col("file")).alias("source_path"),
        F.coalesce(text_field(rec, "$.semantic.language"), text_field(rec, "$.language")).alias("language"), semantic_first(rec, "trust_level").alias("trust_level"),
        text_field(rec, "$.title").alias("title"), F.coalesce(text_field(rec, "$.content"), text_field(rec, "$.text")).alias("content"), semantic_first(rec, "summary_short").alias("summary_short"),
        *[c.alias(f) for f, c in lists.items()],
    )
    chosen = readers.limited(readers.indexable(chunks, exclude_unknown), limit, "doc_id", "chunk_id")
    meta = chosen.select(
        F.concat_ws("::", "doc_id", "chunk_id").alias("chunk_uid"), "chunk_id", "doc_id", "source_path", "language", "trust_level", "content_type", "domain", "artifact_role", "title", "content", "summary_short",
        embed_text(F.col("title"), F.col("content"), F.lit("")).alias("embed_text"),
    )

    def run(batches):
        encode = make_encoder()
        for pdf in batches:
            texts = pdf["embed_text"].tolist()
            x = np.concatenate([np.asarray(encode(texts[k : k + batch_size]), float) for k in range(0, len(texts), batch_size)]) if texts else np.zeros((0, 1))
            if normalize and len(x):
                x = x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-12)
            yield pdf.assign(embedding=list(x.astype(np.float32)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in meta.schema) + ", embedding array<float>"
    coded = meta.mapInPandas(run, schema).drop("embed_text")
    return writers.write_index(number_rows(coded, "doc_id", "chunk_id", name="faiss_id", start=0), index_dir, normalized=normalize, model=model, when=_now())


def retrieve(spark: SparkSession, index_dir: str, chunk: str | None = None, top_k: int = 5) -> DataFrame:
    """Nearest chunks of one chunk (by id or uid), or of all."""
    index, config = readers.read_index(spark, index_dir)
    asked = index if chunk is None else index.where((F.col("chunk_id") == chunk) | (F.col("chunk_uid") == chunk))
    found = vectors.nearest(index, asked, top_k, config["metric"].lower(), "faiss_id", "embedding")
    names = index.select(F.col("faiss_id").alias("query_id"), F.col("chunk_id").alias("query_chunk"))
    return vectors.with_metadata(found, index.drop("embedding"), "faiss_id").join(names, "query_id")


def _sha1(text: str) -> str:
    return hashlib.sha1(text.encode()).hexdigest()


def _provenance(settings: Generation, prompts: Prompts, config: dict) -> F.Column:
    """What a candidate was made from: the search, the locals, the prompts, the model and the plan."""
    c, lit = F.col, F.lit
    hashes = {k: _sha1(getattr(prompts, name)) for k, name in (("plan_system_hash", "plan_system"), ("plan_user_hash", "plan_template"), ("gen_system_hash", "generate_system"), ("gen_user_hash", "generate_template"))}
    plan = F.from_json("plan", "equations_present BOOLEAN, equation_quotes ARRAY<STRING>, generator_checks ARRAY<STRING>, takeaways ARRAY<STRUCT<takeaway STRING, evidence_chunks ARRAY<STRING>>>")
    model = F.map_from_arrays(F.array(*[lit(k) for k, _ in settings.llm]).cast("array<string>"), F.array(*[lit(str(v)) for _, v in settings.llm]).cast("array<string>"))
    return F.struct(
        F.struct(
            lit(config["metric"]).alias("metric"), lit(config["index_type"]).alias("index_type"), lit(bool(config["normalized"])).alias("normalized"),
            c("near").alias("neighbor_chunk_ids"), c("near_scores").alias("neighbor_scores"),
        ).alias("faiss"),
        c("locals").alias("local_neighbor_chunk_ids"), lit(_sha1(json.dumps(asdict(settings), sort_keys=True))).alias("config_hash"),
        F.struct(lit(True).alias("double_pass"), *[lit(v).alias(k) for k, v in hashes.items()]).alias("prompts"),
        lit(hashes["gen_system_hash"]).alias("system_prompt_hash"), lit(hashes["gen_user_hash"]).alias("user_template_hash"), model.alias("llm"), plan.alias("plan"),
    )


def _context_rows(chosen: DataFrame, chunks: DataFrame, index: DataFrame, config: dict, settings: Generation) -> DataFrame:
    """Anchors (``anchor_chunk_id, locals, ...``) with each of their context groups: ``group_no, group, members, near, near_scores``."""
    c = F.col
    higher = config["metric"].upper() == "IP"
    asked = index.join(chosen.select("chunk_id"), "chunk_id", "left_semi")
    facts = index.select("faiss_id", *[x for x in ("chunk_id", "language", "trust_level", "content_type", "domain", "artifact_role") if x in index.columns])
    for field in ("content_type", "domain", "artifact_role"):
        if field not in facts.columns:
            facts = facts.withColumn(field, F.array().cast("array<string>"))
    found = vectors.with_metadata(vectors.nearest(index, asked, settings.top_k, config["metric"].lower(), "faiss_id", "embedding"), facts, "faiss_id")
    own = facts.select(c("faiss_id").alias("query_id"), c("chunk_id").alias("anchor"), c("domain").alias("own_domain"))
    rules = vectors.neighbor_rules(higher, settings.threshold, settings.languages, settings.trust_levels, settings.content_types, settings.artifacts_excluded)
    kept = vectors.eligible_neighbors(found.join(own, "query_id").where(c("chunk_id") != c("anchor")), rules, settings.max_neighbors, higher)
    ranked = kept.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "chunk_id", "score"))).alias("n"))  # at most max_neighbors an anchor
    near = ranked.select(c("anchor").alias("chunk_id"), c("n.chunk_id").alias("near"), c("n.score").alias("near_scores"))
    none = F.array().cast("array<string>")
    found = chosen.join(near, "chunk_id", "left").withColumns({"near": F.coalesce("near", none), "near_scores": F.coalesce("near_scores", F.array().cast("array<double>"))})
    grouped = found.select("*", F.posexplode(vectors.context_groups(F.concat(F.array("chunk_id"), "locals"), c("near"))).alias("group_no", "group"))
    members = grouped.select("anchor_chunk_id", "group_no", F.posexplode("group").alias("at", "member"))
    slim = cand.slim_chunk(chunks)
    context = members.join(chunks.select(c("chunk_id").alias("member"), slim.alias("chunk")), "member").groupBy("anchor_chunk_id", "group_no").agg(F.sort_array(F.collect_list(F.struct("at", "chunk"))).alias("m"))
    return grouped.join(context.select("anchor_chunk_id", "group_no", c("m.chunk").alias("members")), ["anchor_chunk_id", "group_no"])


def generate_candidates(
    spark: SparkSession, semantic_dir: str, index_dir: str, output_dir: str, backend: Backend, prompts: Prompts = DEFAULT_PROMPTS, settings: Generation = Generation(),
    anchors: Callable[[], F.Column] | None = None, resume: bool = True, dry_run: bool = False, files: int = 0, shards: int = 1, shard: int = 0,
) -> DataFrame:
    """Anchors with their locals and neighbours in groups, planned and answered by a model, as candidate records.

    With ``resume`` anchors that ``output_dir`` already holds are left out and new candidates are appended; without, the
    folder is replaced. Budgets count questions: those of a document in the order of its chunks, groups and answers, and
    those of a run in the order of documents, an equal share (rounded up) for each of ``shards``. Anchors are asked in
    waves, as many of a document as it may still give questions, until budgets or anchors are used up. A dry run asks and
    writes nothing and returns the context groups of the first wave.
    """
    c = F.col
    order = F.regexp_extract("chunk_id", r"_c(\d+)$", 1).cast("long")
    read = spark.read.json(semantic_dir).withColumns({"chunk_idx": order, "file": c("_metadata.file_path"), "workspace_file": c("_metadata.file_name")})
    chunks = stored(readers.file_shard(readers.first_files(read, files), shards, shard).drop("file"), "chunks")
    for field in ("content_type", "domain", "chunk_role", "artifact_role"):
        if field not in chunks.columns:
            chunks = chunks.withColumn(field, F.array().cast("array<string>"))
    ok = anchors() if anchors else cand.is_anchor(
        c("language"), c("trust_level"), c("chunk_role"), c("content_type"), c("artifact_role"), c("content"), settings.languages, settings.trust_levels, settings.roles, settings.content_types,
        settings.artifacts_excluded, settings.least_chars, chunks.schema["trust_level"].dataType.typeName() == "array",
    )
    waiting = chunks.withColumn("locals", cand.local_neighbors("chunk_idx", "doc_id", "chunk_id")).where(ok).withColumn("anchor_chunk_id", c("chunk_id"))
    earlier = resume and readers.exists(spark, output_dir)
    if earlier:
        waiting = cand.not_done(waiting, spark.read.schema(CANDIDATE).json(output_dir))
    waiting = stored(waiting.select("anchor_chunk_id", "chunk_id", "doc_id", "chunk_idx", "language", "content_type", "domain", "trust_level", "locals", "workspace_file"), "waiting")
    caps = cand.adaptive_caps(chunks).select(c("doc").alias("doc_id"), "cap") if settings.document_caps else chunks.select("doc_id", F.lit(2**31 - 1).alias("cap")).distinct()
    left = stored(caps, "caps")
    index, config = readers.read_index(spark, index_dir)
    limit = -(-settings.limit // shards)
    made: DataFrame | None = None
    written = 0
    while settings.limit <= 0 or written < limit:
        chosen = stored(cand.within_budget(waiting.join(left, "doc_id"), "doc_id", ["chunk_idx", "chunk_id"], c("cap")).drop("place"), "anchors")
        if chosen.isEmpty():
            break
        context = _context_rows(chosen, chunks, index, config, settings).withColumn("context_text", cand.context_text(c("members")))
        if dry_run:
            return context.drop("cap")
        planned = semantics.with_model(context.withColumn("prompt", F.concat(F.lit(prompts.plan_system + "\n"), cand.render(prompts.plan_template, c("context_text"), settings.max_qa))), "prompt", "plan_text", backend)
        empty = F.lit('{"equation_quotes":[],"equations_present":false,"generator_checks":[],"takeaways":[]}')
        planned = planned.withColumn("plan", F.coalesce(cand.valid_plan(c("plan_text")), empty))
        second = F.concat(F.lit(prompts.generate_system + "\n"), cand.render(prompts.generate_template, c("context_text"), settings.max_qa, c("plan")))
        answered = semantics.with_model(planned.withColumn("prompt", second), "prompt", "answer_text", backend)
        rows = answered.select(
            "anchor_chunk_id", F.coalesce(F.nullif("doc_id", F.lit("")), F.regexp_extract("anchor_chunk_id", "^(.*)_c", 1)).alias("anchor_doc_id"), "doc_id", "chunk_idx", "group_no", "cap", "language", "content_type", "domain",
            "trust_level", "workspace_file", c("group").alias("context"), F.transform("members", cand.ref_of).alias("refs"), _provenance(settings, prompts, config).alias("provenance"), "answer_text",
        )
        pairs = stored(cand.valid_pairs(cand.answered_pairs(rows)), "pairs")
        kept = stored(cand.within_question_budget(pairs, "doc_id", ["chunk_idx", "anchor_chunk_id", "group_no", "qa_idx"], c("cap"), limit - written if settings.limit > 0 else 0), "kept")
        # Appended wave by wave, so that a stopped run loses one wave at most.
        records = stored(cand.candidate_records(kept), "candidates")
        writers.write_jsonl(records, output_dir, mode="append" if earlier or made is not None else "overwrite")
        made = records if made is None else made.unionByName(records)
        written += records.count()
        waiting = stored(cand.not_done(waiting, chosen), "waiting")
        spent = kept.groupBy("doc_id").agg(F.count("*").alias("spent"))
        left = stored(left.join(spent, "doc_id", "left").select("doc_id", (c("cap") - F.coalesce("spent", F.lit(0))).cast("int").alias("cap")).where("cap > 0"), "caps")
    return made if made is not None else spark.createDataFrame([], CANDIDATE_RECORD)


def build_dataset(
    spark: SparkSession, candidate_dir: str, final_dir: str, rules: dataset.Rules = dataset.Rules(), name: str = "qa_final", strategy: str = "sequential", version: str = "auto", dry_run: bool = False,
    files: int = 0, limit: int = 0,
) -> tuple[str, dict]:
    """Candidates to a versioned dataset with its rejects and changelog; the version and the counters.

    ``files`` limits the files read, in the order of their names, and ``limit`` the samples written, in the order of ids.
    """
    rows = readers.first_files(readers.read_jsonl(spark, candidate_dir, "*.json*"), files)
    parsed = readers.good_records(rows).select("file", "line", F.from_json("value", CANDIDATE).alias("c")).select("file", "line", "c.*")
    judged = stored(dataset.judged(parsed, rules), "judged")
    version = writers.next_version(spark, final_dir, name) if version == "auto" else version
    counts = dataset.counters(judged).first().asDict()
    samples = readers.limited(dataset.build(judged.drop("reason"), rules, strategy, version), limit, "id")
    return writers.write_dataset(samples, dataset.rejects(judged), final_dir, name, counts, _now(), version, dry_run), counts


def chunk_report(spark: SparkSession, semantic_dir: str, out: str | None = None, least_doc_chunks: int = 500, examples: int = 300, seed: int = 0) -> dict[str, DataFrame]:
    """Tables of the chunk-quality report over annotated JSON lines of any shape, and with ``out`` up to ``examples`` examples
    of each of six faults."""
    good = readers.good_records(readers.read_jsonl(spark, semantic_dir, "*.json*"))
    rec = F.col("rec")
    fields = ("content_type", "domain", "chunk_role", "artifact_role")

    lists = {f: F.when(kind(rec, f"$.semantic.{f}").isNotNull(), as_list(rec, f"$.semantic.{f}")).otherwise(as_list(rec, f"$.{f}")) for f in fields}
    def malformed(f: str) -> F.Column:
        found = F.coalesce(kind(rec, f"$.semantic.{f}"), kind(rec, f"$.{f}"))
        return F.coalesce(F.startswith(found, F.lit("OBJECT")), F.lit(False))

    flat = good.select(
        F.coalesce(text_field(rec, "$.doc_id"), text_field(rec, "$.title"), F.col("file")).alias("doc_id"), text_field(rec, "$.chunk_id").alias("chunk_id"), record_text(rec).alias("content"),
        F.coalesce(F.nullif(F.lower(F.trim(text_field(rec, "$.language"))), F.lit("")), F.lit("unknown")).alias("language"),
        F.coalesce(text_field(rec, "$.semantic.trust_level"), text_field(rec, "$.trust_level"), F.lit("missing")).alias("trust_level"),
        F.coalesce(text_field(rec, "$.semantic.summary_short"), text_field(rec, "$.summary_short"), F.lit("")).alias("summary_short"),
        F.when(kind(rec, "$.semantic.summary_short").isNotNull(), F.lit(True)).otherwise(kind(rec, "$.summary_short").isNotNull()).alias("has_summary"),
        *[c.alias(f) for f, c in lists.items()], *[malformed(f).alias(f"bad_{f}") for f in fields], F.concat_ws(":", "file", F.lpad(F.col("line").cast("string"), 12, "0")).alias("seen"),
    )
    flat = stored(flat, "flat")
    unknown = F.col("language") == "unknown"
    flags = {"unknown": unknown, "empty_text": is_blank(F.col("content")), "no_domain": F.size("domain") == 0, "no_content_type": F.size("content_type") == 0}
    measured = flat.select(*[c.alias(k) for k, c in ratios(F.col("content")).items()])
    tables = {
        "languages": statistics.counts_with_share(flat, F.col("language"), "language"), "trust": statistics.counts_with_share(flat, F.col("trust_level"), "trust_level"),
        "fill": statistics.list_fill(flat, list(fields), {f: F.col(f"bad_{f}") for f in fields}), "text": measured.agg(*[F.avg(k).alias(k) for k in ("alnum_ratio", "whitespace_ratio", "non_ascii_ratio")], *statistics.length_percentiles(F.col("len_chars"))),
        "summaries": flat.agg(*statistics.length_percentiles(F.length("summary_short"))), "rates": statistics.document_rates(flat, "doc_id", flags, least_doc_chunks),
        **{f"top_{f}": statistics.top_values(flat, f, seen="seen") for f in fields},
    }
    if out:
        writers.write_report(spark, tables, out)
        faults = {
            "language_unknown": unknown, "empty_text": is_blank(F.col("content")), "empty_domain": F.size("domain") == 0, "empty_content_type": F.size("content_type") == 0,
            "empty_summary": ~F.col("has_summary") | is_blank(F.col("summary_short")), "missing_trust": F.col("trust_level") == "missing",
        }
        if examples > 0:
            chosen = [writers.example_rows(statistics.seeded_examples(flat.where(c), "chunk_id", examples, seed), reason, "content", examples) for reason, c in faults.items()]
            found = chosen[0]
            for more in chosen[1:]:
                found = found.unionByName(more)
            writers.write_jsonl(found, f"{out}_examples")
    return tables


def qa_report(spark: SparkSession, candidate_dir: str, out: str | None = None, top_n: int = 50, least: int = 1, pattern: str = "*.json*") -> dict[str, DataFrame]:
    """Tables of the candidate report: counts per chunk and document, and how they are spread."""
    rows = readers.read_jsonl(spark, candidate_dir, pattern)
    rec = F.col("rec")

    def first(*names: str) -> F.Column:
        return F.coalesce(*[F.nullif(F.trim(text_field(rec, f"$.{n}")), F.lit("")) for n in names])

    good = readers.good_records(rows).select(
        first("anchor_chunk_id", "chunk_id", "anchor_chunk").alias("chunk"), first("anchor_doc_id", "doc_id").alias("doc"), F.coalesce(first("difficulty"), F.lit("missing")).alias("difficulty"),
        F.coalesce(first("language"), F.lit("missing")).alias("language"),
    )
    good = stored(good, "qa")
    per_chunk = stored(good.where("chunk is not null").groupBy("chunk").agg(F.count("*").alias("n")).where(F.col("n") >= least), "per_chunk")
    per_doc = good.where("doc is not null").groupBy("doc").agg(F.count("*").alias("n"))
    tables = {
        "lines": readers.line_counts(rows).agg(F.sum("n_lines").alias("lines"), F.sum("n_bad").alias("bad")), "summary": statistics.summary(per_chunk, "n"), "ranks": statistics.nearest_ranks(per_chunk, "n"),
        "gini": statistics.gini(per_chunk, "n"), "pareto": statistics.pareto_shares(per_chunk, "n"), "top_chunks": per_chunk.orderBy(F.desc("n"), "chunk").limit(top_n),
        "top_docs": per_doc.orderBy(F.desc("n"), "doc").limit(top_n),
    }
    if out:
        writers.write_report(spark, tables, out)
        maps = statistics.counter_maps(good.where("chunk is not null"), "chunk", "difficulty").withColumnRenamed("counts", "difficulty_counts")
        languages = statistics.counter_maps(good.where("chunk is not null"), "chunk", "language").withColumnRenamed("counts", "language_counts")
        writers.counts_csv(per_chunk.join(maps, "chunk").join(languages, "chunk"), f"{out}_csv", ("difficulty_counts", "language_counts"))
    return tables

