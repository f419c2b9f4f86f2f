"""Typed reads from landed JSON (Variant). Variant casts are loose, so types are checked first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketloom.functions.text import trim_ws


def with_parsed(df: DataFrame, payload: str = "payload", path: str = "$", name: str = "_r") -> DataFrame:
    """Replace a JSON text column by its Variant at ``path``, parsed once per row.

    The one-element generator keeps filters on parsed fields above it; pushed below a plain
    projection they would parse the text again for every field they read.
    """
    parsed = parse(F.col(payload))
    value = parsed if path == "$" else field(parsed, path)
    kept = [c for c in df.columns if c != payload]
    return df.select(*kept, F.inline(F.array(F.struct(value.alias(name)))))


def parse(payload: Column) -> Column:
    return F.try_parse_json(payload)


def field(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def type_name(v: Column) -> Column:
    """'STRING', 'BIGINT', 'OBJECT<..>' ...; NULL for a missing value, 'VOID' for JSON null."""
    return F.schema_of_variant(v)


def is_object(v: Column) -> Column:
    return F.coalesce(type_name(v).startswith("OBJECT"), F.lit(False))


def is_array(v: Column) -> Column:
    return F.coalesce(type_name(v).startswith("ARRAY"), F.lit(False))


def is_number(v: Column) -> Column:
    return F.coalesce(type_name(v).rlike(r"\A(BIGINT|DECIMAL.*|DOUBLE|FLOAT)\z"), F.lit(False))


def is_string(v: Column) -> Column:
    return F.coalesce(type_name(v) == "STRING", F.lit(False))


def text_of(f: Column) -> Column:
    """Trimmed text of a JSON string that is not blank; NULL for every other value. Each step is evaluated once, also in
    lambdas, where nothing is shared."""
    trimmed = F.transform(F.array(f), lambda x: F.when(type_name(x) == "STRING", trim_ws(F.try_variant_get(x, "$", "string"))))
    return F.get(F.filter(trimmed, lambda t: t != ""), 0)


def optional_text(v: Column, path: str) -> Column:
    return text_of(field(v, path))


def any_text(v: Column, path: str) -> Column:
    """Text of any scalar, the way an untyped source field is read."""
    return F.try_variant_get(v, path, "string")


def boolean(v: Column, path: str) -> Column:
    f = field(v, path)
    return F.when(type_name(f) == "BOOLEAN", F.try_variant_get(f, "$", "boolean"))


def number(v: Column, path: str, to: str) -> Column:
    f = field(v, path)
    return F.when(is_number(f), F.try_variant_get(f, "$", to))


def array(v: Column, path: str) -> Column:
    """Elements of a JSON array as array<variant>; empty for anything else."""
    f = field(v, path)
    return F.coalesce(
        F.when(is_array(f), F.try_variant_get(f, "$", "array<variant>")), F.array().cast("array<variant>")
    )


def canonical_json(payload: Column) -> Column:
    """Compact JSON with sorted keys; anything but an object becomes ``{}``."""
    v = parse(payload)
    return F.when(is_object(v), F.to_json(v)).otherwise(F.lit("{}"))
