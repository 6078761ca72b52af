"""Stable ids and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill.functions.text import first_nonblank, strip


def sha1_16(text: Column) -> Column:
    return F.substring(F.sha1(text), 1, 16)


def int_hash(text: Column) -> Column:
    """The first 32 bits of the text's SHA-1 as a number."""
    return F.conv(F.substring(F.sha1(text), 1, 8), 16, 10).cast("long")


def document_id(path: Column) -> Column:
    """``pdf_`` + the relative path with ``__`` for slashes and without its suffix + eight digits of its SHA-1."""
    bare = F.regexp_replace(path, r"\.[^./]*$", "")
    return F.concat(F.lit("pdf_"), F.replace(bare, F.lit("/"), F.lit("__")), F.lit("_"), F.substring(F.sha1(bare), 1, 8))


def chunk_id(doc_id: Column, index: Column) -> Column:
    return F.format_string("%s_c%04d", doc_id, index)


def candidate_id(anchor: Column, question: Column, answer: Column, index: Column) -> Column:
    """Anchor and sixteen digits of the SHA-1 of the canonical JSON of answer, index and question."""
    return F.concat(anchor, F.lit(":"), sha1_16(F.to_json(F.struct(answer.alias("a"), index.alias("i"), question.alias("q")))))


def fingerprint(*columns: Column) -> Column:
    """Sixteen digits of the SHA-1 of the stripped fields, one a line (``None`` for a missing one)."""
    return sha1_16(F.concat_ws("\n", *[F.coalesce(strip(c), F.lit("None")) for c in columns]))


def shard_of(n_shards: int, anchor: Column, candidate: Column, question: Column) -> Column:
    key = F.coalesce(first_nonblank(anchor, candidate), question, F.lit(""))
    return F.pmod(int_hash(key), F.lit(n_shards)).cast("int")


def sequential_id(abbr: str, seq: Column, width: int = 5) -> Column:
    return F.concat(F.lit(f"{abbr}_"), F.format_string(f"%0{width}d", seq), F.lit("_q1"))


def hash_id(abbr: str, anchor: Column, instruction: Column, output: Column) -> Column:
    base = F.concat_ws("\n", *[F.coalesce(c, F.lit("")) for c in (anchor, instruction, output)])
    return F.concat(F.lit(f"{abbr}_"), sha1_16(base), F.lit("_q1"))
