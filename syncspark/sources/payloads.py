"""Response payloads: one JSON text per fetched page.

Payload rows carry ``space_key, page_no, start_at, payload``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from syncspark.functions.paths import json_path, struct_path
from syncspark.functions.text import node_int


def _wrap(schema: T.DataType, path: str | None) -> T.DataType:
    """Schema of a response that holds ``schema`` at ``path``."""
    for part in reversed(path.split(".") if path else []):
        schema = T.StructType([T.StructField(part, schema)])
    return schema


def _merge(left: T.DataType, right: T.DataType) -> T.DataType:
    if not (isinstance(left, T.StructType) and isinstance(right, T.StructType)):
        return left
    merged = {f.name: f.dataType for f in left.fields}
    for f in right.fields:
        merged[f.name] = _merge(merged[f.name], f.dataType) if f.name in merged else f.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in merged.items()])


def extract_documents(
    payloads: DataFrame, schema: T.StructType, docs_path: str | None = None,
    root_fields: dict[str, tuple[str, str]] | None = None, carry: list[str] = ("space_key", "page_no"),
    column: str = "payload",
) -> DataFrame:
    """Documents of each response, in order, as columns next to ``carry`` and ``pos``.

    ``root_fields`` copies response-level values into every document as
    ``{name: (path, type)}``; they overwrite a document's own field, also with null.
    A response without an array at the expected place fails the run.
    """
    roots = dict(root_fields or {})
    response: T.DataType = _wrap(T.ArrayType(schema), docs_path)
    for path, kind in roots.values():
        response = _merge(response, _wrap(T.DataType.fromDDL(kind), path))
    parsed = F.from_json(F.col(column), response, {"mode": "PERMISSIVE"})
    staged = payloads.select(*carry, F.col(column), parsed.alias("_r"))
    docs = F.col("_r") if docs_path is None else struct_path(response, docs_path, F.col("_r"))
    wrong = docs.isNull()
    if docs_path is None:
        # A single object at the root would pass for an array of one.
        wrong = wrong | ~F.startswith(F.ltrim(column), F.lit("["))
    checked = F.when(wrong, F.raise_error(F.lit("response holds no array of documents"))).otherwise(docs)
    held = {name: f"_root_{i}" for i, name in enumerate(roots)}
    rows = staged.select(
        *carry,
        *[struct_path(response, roots[name][0], F.col("_r")).alias(alias) for name, alias in held.items()],
        F.posexplode(checked).alias("pos", "_d"),
    )
    own = [F.col("_d")[f.name].alias(f.name) for f in schema.fields if f.name not in roots]
    return rows.select(*carry, F.col("pos").cast("bigint").alias("pos"), *own, *[F.col(a).alias(n) for n, a in held.items()])


def extract_open_documents(
    payloads: DataFrame, names: list[str], docs_path: str | None = None, carry: list[str] = ("space_key", "page_no"),
    column: str = "payload",
) -> DataFrame:
    """Documents whose schema nobody knows: ``names`` of each one as VARIANT columns next to
    ``carry`` and ``pos``.

    ``SyncConfig.first_names`` gives the names a configuration needs; its paths lead on into
    the VARIANT, and a value may have another type in every document. A response that is not
    JSON or has no array at the expected place fails the run.
    """
    steps = docs_path.split(".") if docs_path else []
    docs = F.try_variant_get(F.try_parse_json(column), json_path(steps), "array<variant>")
    checked = F.coalesce(docs, F.raise_error(F.lit("response holds no array of documents")))
    rows = payloads.select(*carry, F.posexplode(checked).alias("pos", "_d"))
    own = [F.try_variant_get(F.col("_d"), json_path([name]), "variant").alias(name) for name in names]
    return rows.select(*carry, F.col("pos").cast("bigint").alias("pos"), *own)


def extract_total(payload: Column, total_path: str | None) -> Column:
    """Total count of a response; configured but missing or not a number fails the run."""
    if total_path is None:
        return F.lit(None).cast("int")
    raw = F.get_json_object(payload, "$." + total_path)
    missing = F.raise_error(F.lit("configured total count has no value"))
    return F.when(raw.isNull(), missing).otherwise(node_int(raw))


def extract_spaces(payloads: DataFrame, path: str | None = None, column: str = "payload") -> DataFrame:
    """Space keys from an array, as text, or from the keys of an object."""
    body = F.col(column) if path is None else F.get_json_object(column, "$." + path)
    opening = F.substring(F.ltrim(body), 1, 1)
    keys = (
        F.when(opening == "[", F.from_json(body, "array<string>"))
        .when(opening == "{", F.json_object_keys(body))
        .otherwise(F.raise_error(F.lit("response holds no list of spaces")))
    )
    return payloads.select(F.explode(keys).alias("space_key")).distinct()
