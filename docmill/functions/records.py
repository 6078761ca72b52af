"""JSON that was not written to a schema: variant columns, scalar-or-list fields, JSON inside prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill.functions.text import TEXT_FIELDS, TEXT_PARENTS, first_nonblank_raw


def kind(value: Column, path: str = "$") -> Column:
    """Type name of a field: VOID for JSON null, null if it is absent."""
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def is_object(value: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), F.lit(False))


def text_field(value: Column, path: str) -> Column:
    """The field if it is a string."""
    return F.when(kind(value, path) == "STRING", F.try_variant_get(value, path, "string"))


def as_list(value: Column, path: str) -> Column:
    """A list's elements, or a scalar as a list of one; an absent or null field is empty."""
    k = kind(value, path)
    return (
        F.when(k.isNull() | (k == "VOID"), F.array().cast("array<string>"))
        .when(F.startswith(k, F.lit("ARRAY")), F.try_variant_get(value, path, "array<string>"))
        .otherwise(F.array(F.try_variant_get(value, path, "string")))
    )


def semantic_first(value: Column, field: str, type_name: str = "string") -> Column:
    """A top-level field where the record has it, else the same field of its semantic object."""
    top = kind(value, f"$.{field}")
    return F.when(top.isNotNull(), F.try_variant_get(value, f"$.{field}", type_name)).otherwise(F.try_variant_get(value, f"$.semantic.{field}", type_name))


def record_text(value: Column) -> Column:
    """The first non-blank text under any of the usual names, then inside the usual nested objects; else empty."""
    paths = [f"$.{n}" for n in TEXT_FIELDS] + [f"$.{p}.{n}" for p in TEXT_PARENTS for n in TEXT_FIELDS]
    return first_nonblank_raw(*[text_field(value, p) for p in paths])


def json_object(text: Column) -> Column:
    """The text as a JSON object, or the object from its first opening to its last closing brace; null if neither is one."""
    whole, inner = F.try_parse_json(text), F.try_parse_json(F.regexp_extract(text, r"(?s)\{.*\}", 0))
    return F.when(is_object(whole), whole).when(is_object(inner), inner)


def json_array(text: Column) -> Column:
    """Likewise for an array."""

    def array_only(v: Column) -> Column:
        return F.when(F.startswith(F.schema_of_variant(v), F.lit("ARRAY")), v)

    return F.coalesce(array_only(F.try_parse_json(text)), array_only(F.try_parse_json(F.regexp_extract(text, r"(?s)\[.*\]", 0))))
