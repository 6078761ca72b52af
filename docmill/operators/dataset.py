"""Candidates to instruction samples: reject reasons, mapping, exact deduplication, ids, counters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions.hashing import fingerprint, hash_id, sequential_id
from docmill.functions.records import is_object, kind
from docmill.functions.text import detect_language, first_nonblank, is_blank, slug, strip
from docmill.operators.candidates import CONTENT_TYPES, overlaps
from docmill.operators.ordering import first_rows, number_rows


@dataclass(frozen=True)
class Rules:
    """What a candidate must meet; an empty list of allowed values allows all."""

    least_question: int = 20
    most_question: int = 600
    least_answer: int = 30
    most_answer: int = 2000
    languages: tuple[str, ...] = ("de", "en")
    trust_levels: tuple[str, ...] = ("high", "medium")
    content_types: tuple[str, ...] = CONTENT_TYPES
    need_sources: bool = True
    drop_mismatch: bool = False


def _texts(values: Column) -> Column:
    return F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: ~is_blank(v))


def reject_reason(rules: Rules = Rules()) -> Column:
    """The first rule that a candidate fails; null if it passes. Labels that are absent pass."""
    q, a = strip(F.col("question")), strip(F.col("answer"))
    language, trust, types = first_nonblank(F.col("language")), first_nonblank(F.col("trust_level")), _texts(F.col("content_type"))
    checks = [
        (is_blank(F.col("question")), "missing_or_empty:question"), (is_blank(F.col("answer")), "missing_or_empty:answer"),
        (F.length(q) < rules.least_question, "question_too_short"), (F.length(q) > rules.most_question, "question_too_long"),
        (F.length(a) < rules.least_answer, "answer_too_short"), (F.length(a) > rules.most_answer, "answer_too_long"),
    ]
    if rules.languages:
        checks.append((~language.isin(*rules.languages), "language_not_allowed"))
    if rules.trust_levels:
        checks.append((~trust.isin(*rules.trust_levels), "trust_level_not_allowed"))
    if rules.content_types:
        checks.append(((F.size(types) > 0) & ~overlaps(types, rules.content_types), "content_type_not_allowed"))
    if rules.need_sources:
        checks.append((F.coalesce(F.size("source_chunks") == 0, F.lit(True)), "missing_sources"))
    if rules.drop_mismatch:
        seen = detect_language(F.concat_ws(" ", q, a))
        checks.append((language.isin("de", "en") & seen.isin("de", "en") & (seen != language), "language_mismatch"))
    return F.coalesce(*[F.when(c, reason) for c, reason in checks])


def valid_sample(rec: Column) -> Column:
    """Whether an intermediate sample (a variant) has an instruction and an output that are strings."""
    return F.coalesce(is_object(rec) & (kind(rec, "$.instruction") == "STRING") & (kind(rec, "$.output") == "STRING"), F.lit(False))


def instruction_columns(version: str = "v1", input_value: str = "") -> list[Column]:
    """The sample's columns of a candidate."""
    domain = _texts(F.col("domain"))
    topic = F.coalesce(first_nonblank(F.col("topic")), slug(F.get(domain, F.lit(0))), F.lit(""))
    named = F.transform(F.filter(F.col("source_chunks"), lambda c: ~is_blank(c)), lambda c: F.concat(F.lit("chunk:"), strip(c)))
    anchor_only = F.when(F.col("anchor_chunk_id").isNotNull(), F.array(F.concat(F.lit("chunk:"), F.col("anchor_chunk_id")))).otherwise(F.array().cast("array<string>"))
    return [
        strip(F.col("question")).alias("instruction"), F.lit(input_value).alias("input"), strip(F.col("answer")).alias("output"),
        F.coalesce(first_nonblank(F.col("language")), F.lit("unknown")).alias("language"), _texts(F.col("content_type")).alias("content_type"), domain.alias("domain"),
        F.coalesce(first_nonblank(F.col("trust_level")), F.lit("unknown")).alias("trust_level"), F.coalesce(named, anchor_only).alias("source_ids"),
        F.lit("llm_auto").alias("created_by"), F.lit(version).alias("version"), F.col("id").alias("candidate_id"), "anchor_chunk_id", "anchor_doc_id", "difficulty",
        F.coalesce(first_nonblank(F.col("workspace")), F.lit("")).alias("workspace"), topic.alias("topic"),
    ]


def judged(candidates: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Candidates with their reject ``reason``; split on its absence for samples and rejects."""
    return candidates.withColumn("reason", reject_reason(rules))


def rejects(judged_rows: DataFrame, order: tuple[str, ...] = ("file", "line")) -> DataFrame:
    return judged_rows.where("reason is not null").select("reason", *order, F.col("id").alias("candidate_id"), "anchor_chunk_id")


def deduplicated(samples: DataFrame, keys: tuple[str, ...] = ("instruction", "output"), order: tuple[str, ...] = ("file", "line")) -> DataFrame:
    """The first sample of each fingerprint in order; two-phase, so a fingerprint of many copies is one row a task."""
    marked = samples.withColumn("fp", fingerprint(*[F.col(k) for k in keys]))
    return first_rows(marked, ["fp"], *order)


def with_ids(samples: DataFrame, strategy: str = "sequential", abbr: str = "ws", width: int = 5, order: tuple[str, ...] = ("file", "line")) -> DataFrame:
    """Samples with ``id``: numbered in order, the candidate's own, or a hash. Candidates without an id are numbered."""
    if strategy == "hash":
        return samples.withColumn("id", hash_id(abbr, F.col("anchor_chunk_id"), F.col("instruction"), F.col("output")))
    numbered = number_rows(samples, *order)
    number = sequential_id(abbr, F.col("seq"), width)
    return numbered.withColumn("id", F.coalesce(first_nonblank(F.col("candidate_id")), number) if strategy == "candidate" else number).drop("seq")


def build(candidates: DataFrame, rules: Rules = Rules(), strategy: str = "sequential", version: str = "v1", order: tuple[str, ...] = ("file", "line"), existing: DataFrame | None = None) -> DataFrame:
    """Samples of candidates: judged, mapped, deduplicated, numbered, without ids that exist already."""
    kept = judged(candidates, rules).where("reason is null").select(*order, *instruction_columns(version))
    out = with_ids(deduplicated(kept, order=order), strategy, order=order)
    return out.join(existing.select("id").distinct(), "id", "left_anti") if existing is not None else out


def counters(judged_rows: DataFrame) -> DataFrame:
    """One row: how many candidates were read, kept, dropped and duplicates of a kept one."""
    good = F.col("reason").isNull()
    fp = F.when(good, fingerprint(F.col("question"), F.col("answer")))
    sums = judged_rows.agg(F.count("*").alias("n_read"), F.count_if(good).alias("n_valid"), F.count_distinct(fp).alias("n_kept"))
    return sums.select("n_read", "n_kept", (F.col("n_read") - F.col("n_valid")).alias("n_dropped"), (F.col("n_valid") - F.col("n_kept")).alias("n_duped"))
