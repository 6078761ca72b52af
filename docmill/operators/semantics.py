"""Annotation of chunks: what needs a model, what the model said, and what is kept of it."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.functions.records import as_list, json_object, kind, text_field
from docmill.functions.text import is_blank, strip, structural_mode
from docmill.schemas import TAXONOMY

#: How many ids of a field are kept.
KEPT = {"content_type": 2, "domain": 3, "artifact_role": 3, "chunk_role": 2}


#: Ids of each field, with labels and descriptions where they are known.
Taxonomy = dict[str, list[tuple[str, str | None, str | None]]]
PLAIN: Taxonomy = {field: [(i, None, None) for i in ids] for field, ids in TAXONOMY.items()}


def ids_of(taxonomy: Taxonomy, field: str) -> list[str]:
    return [i for i, _, _ in taxonomy.get(field, [])]


def allowed_only(values: Column, field: str, limit: int | None = None, taxonomy: Taxonomy = PLAIN) -> Column:
    """Ids of the field's taxonomy in their order, each once, cut at ``limit``."""
    allowed = F.array(*[F.lit(v) for v in ids_of(taxonomy, field)]).cast("array<string>")
    kept = F.array_distinct(F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.array_contains(allowed, v)))
    return F.slice(kept, 1, limit) if limit else kept


def normalized_semantics(raw: Column, taxonomy: Taxonomy = PLAIN) -> dict[str, Column]:
    """Columns of a semantic object (a variant) held to the taxonomies; anything ill-typed becomes the field's default."""

    def list_only(field: str) -> Column:
        return F.when(F.startswith(kind(raw, f"$.{field}"), F.lit("ARRAY")), as_list(raw, f"$.{field}"))

    language = F.try_variant_get(raw, "$.language", "string")
    trust = F.trim(F.try_variant_get(raw, "$.trust_level", "string"))
    equations = F.when(F.startswith(kind(raw, "$.equations"), F.lit("ARRAY")), F.try_variant_get(raw, "$.equations", "array<variant>"))
    described = F.transform(
        F.coalesce(equations, F.array().cast("array<variant>")),
        lambda e: F.when(F.startswith(F.schema_of_variant(e), F.lit("OBJECT")), F.to_json(e)).otherwise(
            F.to_json(F.struct(F.coalesce(F.try_variant_get(e, "$", "string"), F.lit("None")).alias("description")))
        ),
    )
    out = {f: allowed_only(list_only(f), f, n, taxonomy) for f, n in KEPT.items()}
    return out | {
        "language": F.when(language.isin(ids_of(taxonomy, "language")), language).otherwise("unknown"),
        "trust_level": F.when(trust.isin(ids_of(taxonomy, "trust_level")), trust).otherwise("medium"),
        "summary_short": F.coalesce(strip(text_field(raw, "$.summary_short")), F.lit("")),
        "equations": described,
        "key_quantities": F.coalesce(list_only("key_quantities"), F.array().cast("array<string>")),
    }


def needs_annotation(existing_trust: Column) -> Column:
    """A chunk that has a trust level was annotated before."""
    return is_blank(existing_trust)


def annotation_text(chunks: DataFrame, doc: str = "doc_id", order: str = "chunk_idx", content: str = "content", heading: str = "has_heading", short: int = 80) -> DataFrame:
    """Adds ``prev_text, next_text, llm_text``: a short chunk with a heading is read with the next one or two."""
    w = Window.partitionBy(doc).orderBy(order)
    text = F.col(content)
    one, two = F.lead(text, 1).over(w), F.lead(text, 2).over(w)
    joined = F.concat_ws("\n\n", text, F.nullif(strip(one), F.lit("")), F.nullif(strip(two), F.lit("")))
    extended = F.col(heading) & (F.length(strip(text)) < short)
    return chunks.select("*", F.lag(text, 1).over(w).alias("prev_text"), one.alias("next_text"), F.when(extended, joined).otherwise(text).alias("llm_text"))


def annotation_prompt(title: Column, text: Column, before: Column, after: Column, main_chars: int = 4000, side_chars: int = 1000, taxonomy: Taxonomy = PLAIN) -> Column:
    """Prompt of the classifier: the taxonomies (a constant), the title, the neighbours and the clipped text.

    A field whose entries have labels or descriptions is listed an entry a line.
    """

    def listed(entries: list[tuple[str, str | None, str | None]]) -> str:
        if not any(label or text for _, label, text in entries):
            return " " + ", ".join(i for i, _, _ in entries)
        return "".join(f"\n- {i}" + (f" ({label})" if label else "") + (f": {text}" if text else "") for i, label, text in entries)

    lists = "\n".join(f"{field}:{listed(entries)}" for field, entries in taxonomy.items())

    def clip(c: Column, n: int) -> Column:
        return F.substring(F.coalesce(strip(c), F.lit("")), 1, n)

    return F.concat(
        F.lit(f"Classify the chunk. Answer with one JSON object.\n{lists}\nTitle: "), F.coalesce(title, F.lit("")), F.lit("\nBefore: "), clip(before, side_chars),
        F.lit("\nAfter: "), clip(after, side_chars), F.lit("\nChunk: "), clip(text, main_chars),
    )


def chat_backend(url: str, model: str, system: str = "", timeout: float = 120.0, **options: float) -> Callable[[], Callable[[str], str | None]]:
    """Backend of a chat server: a POST of messages as JSON, the answer's message content; null if the call fails.

    ``options`` (temperature, top_p, num_ctx ...) go along. The factory is what :func:`with_model` takes.
    """

    def make() -> Callable[[str], str | None]:
        import urllib.request

        def ask(prompt: str) -> str | None:
            messages = ([{"role": "system", "content": system}] if system else []) + [{"role": "user", "content": prompt}]
            body = json.dumps({"model": model, "messages": messages, "stream": False, "options": options}).encode()
            request = urllib.request.Request(url, body, {"Content-Type": "application/json"})
            with urllib.request.urlopen(request, timeout=timeout) as reply:
                return json.loads(reply.read())["message"]["content"]

        return ask

    return make


def stub_backend(prompt: str) -> str | None:
    """A deterministic stand-in for a model: an object whose fields follow from the prompt's length."""
    n = len(prompt)
    return json.dumps(
        {
            "language": TAXONOMY["language"][n % 4], "content_type": [TAXONOMY["content_type"][n % 16]], "domain": [TAXONOMY["domain"][n % 14]],
            "artifact_role": [], "chunk_role": [TAXONOMY["chunk_role"][n % 6]], "trust_level": TAXONOMY["trust_level"][n % 3], "summary_short": prompt[-60:].strip(),
            "equations": [], "key_quantities": [],
        }
    )


def with_model(df: DataFrame, prompt: str, answer: str, make_backend: Callable[[], Callable[[str], str | None]] = lambda: stub_backend) -> DataFrame:
    """Adds the model's answer (null where it failed). The backend is made once a partition; a failing row fails alone."""
    schema = T.StructType([*df.schema.fields, T.StructField(answer, T.StringType())])
    at = df.columns.index(prompt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = make_backend()

        def safe(p: str | None) -> str | None:
            try:
                return None if p is None else ask(p)
            except Exception:  # noqa: BLE001  a model call may fail in any way; the row stays unanswered and is asked again on a rerun
                return None

        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([safe(p) for p in batch.column(at).to_pylist()], pa.string())], names=[*batch.schema.names, answer])

    return df.mapInArrow(run, schema)


def after_rules(summary: Column, content: Column, has_heading: Column, has_table: Column) -> Column:
    """Summaries of headings, tables and very short chunks are dropped when they are short themselves."""
    return F.when(is_weak(content, has_heading, has_table) & (F.length(summary) < 20), "").otherwise(summary)


def empty_reasons(content_type: Column, domain: Column, artifact_role: Column, said: Column, summary: Column, weak: Column) -> Column:
    """Why fields are empty: the model gave nothing (of the roles, before any were added), or the rule for weak chunks took
    the summary away; null where they are not."""
    nothing = F.lit("llm_empty")
    suppressed = weak & (F.length(said) < 20)
    return F.struct(
        F.when(F.size(content_type) == 0, nothing).alias("content_type"), F.when(F.size(domain) == 0, nothing).alias("domain"), F.when(F.size(artifact_role) == 0, nothing).alias("artifact_role"),
        F.when(suppressed, "rule4_suppressed").when(summary == "", nothing).alias("summary_short"),
    )


def is_weak(content: Column, has_heading: Column, has_table: Column) -> Column:
    return has_heading | has_table | (F.length(strip(F.coalesce(content, F.lit("")))) < 40)


def structural_roles(roles: Column, has_heading: Column, has_table: Column, allowed: tuple[str, ...] = tuple(TAXONOMY["artifact_role"])) -> Column:
    """Roles with ``heading`` and ``table`` added for chunks that have one, where the taxonomy knows them."""
    for role, has in (("heading", has_heading), ("table", has_table)):
        if role in allowed:
            roles = F.when(has & ~F.array_contains(roles, role), F.array_append(roles, role)).otherwise(roles)
    return roles


def annotate(chunks: DataFrame, make_backend: Callable[[], Callable[[str], str | None]] = lambda: stub_backend, taxonomy: Taxonomy = PLAIN) -> DataFrame:
    """Chunks (doc_id, chunk_idx, content, title, has_heading, has_table, trust_level) with ``mode`` and semantic columns.

    Structural chunks and chunks annotated before never reach the model; a failed call leaves the row with mode ``failed``.
    """
    known = chunks.withColumnRenamed("trust_level", "known_trust")
    read = annotation_text(known).withColumn("mode", F.when(~needs_annotation(F.col("known_trust")), "existing").otherwise(F.coalesce(structural_mode(F.col("content")), F.lit("llm"))))
    asked = read.withColumn("prompt", F.when(F.col("mode") == "llm", annotation_prompt(F.col("title"), F.col("llm_text"), F.col("prev_text"), F.col("next_text"), taxonomy=taxonomy)))
    answered = with_model(asked, "prompt", "answer", make_backend).withColumn("raw", json_object(F.col("answer")))
    fields = normalized_semantics(F.col("raw"), taxonomy)
    # The annotation's fields take the place of what the record says of the same name.
    out = answered.select(*[c for c in answered.columns if c not in fields], *[c.alias(name) for name, c in fields.items()])
    out = out.withColumn("mode", F.when((F.col("mode") == "llm") & F.col("raw").isNull(), "failed").otherwise(F.col("mode")))
    out = out.withColumn("trust_level", F.coalesce("known_trust", F.when(F.col("mode") != "failed", F.col("trust_level"))))
    c = F.col
    short = after_rules(c("summary_short"), c("content"), c("has_heading"), c("has_table"))
    reasons = empty_reasons(c("content_type"), c("domain"), c("artifact_role"), c("summary_short"), short, is_weak(c("content"), c("has_heading"), c("has_table")))
    out = out.withColumns({"empty_reasons": F.when(c("mode") == "llm", reasons), "summary_short": short, "artifact_role": structural_roles(c("artifact_role"), c("has_heading"), c("has_table"), tuple(ids_of(taxonomy, "artifact_role")))})
    return out.drop("prompt", "answer", "raw", "known_trust", "prev_text", "next_text", "llm_text")


def suspect_structural(language: Column, domain: Column, content_type: Column, summary: Column, chunk_role: Column, equations: Column, quantities: Column, text: Column) -> Column:
    """Nothing known and hardly any text: all of eight signs together."""

    def empty(c: Column) -> Column:
        return F.coalesce(F.size(c) == 0, F.lit(True))

    return (
        (language == "unknown") & empty(domain) & empty(content_type) & empty(chunk_role) & empty(equations) & empty(quantities)
        & (F.length(F.coalesce(summary, F.lit(""))) < 10) & (F.length(F.coalesce(text, F.lit(""))) < 80)
    )
