"""Projection of source documents by configuration."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, functions as F, types as T

from syncspark.config import FieldMapping, SyncConfig
from syncspark.functions.paths import path_type, simple_string, struct_path, variant_list, variant_object


def remap_struct(value: Column, kind: T.StructType, renames: dict[str, str]) -> Column:
    """Keep and rename the listed members; all are read before any is written."""
    kept = {new: old for old, new in renames.items() if old in kind.names}
    if not kept:
        return F.lit(None)
    return F.when(value.isNotNull(), F.struct(*[value[old].alias(new) for new, old in kept.items()]))


def remap_map(value: Column, renames: dict[str, str]) -> Column:
    """Same for a map column; of listed keys with one new name, the last that is there counts."""
    if len(set(renames.values())) < len(renames):
        entries = []
        for name in dict.fromkeys(renames.values()):
            entry = F.lit(None)
            for old in (old for old, new in renames.items() if new == name):
                entry = F.when(F.map_contains_key(value, old), F.struct(F.lit(name).alias("key"), value[old].alias("value"))).otherwise(entry)
            entries.append(entry)
        return F.when(value.isNotNull(), F.map_from_entries(F.array_compact(F.array(*entries))))
    table = F.create_map(*[F.lit(item) for pair in renames.items() for item in pair])
    listed = F.map_filter(value, lambda key, _: key.isin(*renames))
    return F.transform_keys(listed, lambda key, _: table[key])


def remap_variant(value: Column, renames: dict[str, str]) -> Column:
    """Same for a VARIANT, by what it holds in each row: an object, a list whose objects are
    meant, or a value that stays. Members that are null are left out."""

    def one(item: Column) -> Column:
        members = F.map_filter(variant_object(item), lambda _, member: ~F.is_variant_null(member))
        return F.when(members.isNotNull(), F.to_variant_object(remap_map(members, renames))).otherwise(item)

    items = variant_list(value)
    return F.when(items.isNotNull(), F.to_variant_object(F.transform(items, one))).otherwise(one(value))


def filter_keys(value: Column, keep: list[str]) -> Column:
    """Map entries with a listed key; an empty list changes nothing."""
    if not keep:
        return value
    return F.map_filter(value, lambda key, _: key.isin(*keep))


def value_filter(value: Column, kind: T.DataType | None, renames: dict[str, str] | None, name: str = "") -> Column:
    """Apply a filter to an object or to every object of an array; scalars pass unchanged."""
    if kind is None or not renames:
        return value
    if isinstance(kind, T.StructType):
        return remap_struct(value, kind, renames)
    if isinstance(kind, T.MapType):
        return remap_map(value, renames)
    if isinstance(kind, T.VariantType):
        return remap_variant(value, renames)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.MapType, T.VariantType)):
        return F.transform(value, lambda item: value_filter(item, kind.elementType, renames))
    warnings.warn(f"filter defined for a field that holds no object: '{name}'", stacklevel=2)
    return value


def mapped_columns(
    schema: T.StructType,
    fields: dict[str, FieldMapping],
    filters: dict[str, dict[str, str]],
    root: Column | None = None,
) -> list[Column]:
    """One output column per configured field, relative to ``root`` or to the row."""
    out = []
    for name, mapping in fields.items():
        kind = path_type(schema, mapping.remote_field)
        value = struct_path(schema, mapping.remote_field, root)
        if isinstance(kind, T.VariantType):
            value = F.when(~F.is_variant_null(value), value)
        renames = filters.get(mapping.value_filter) if mapping.value_filter else None
        out.append(value_filter(value, kind, renames, mapping.remote_field).alias(name))
    return out


def standard_columns(cfg: SyncConfig, space_key: Column, document_id: Column) -> list[Column]:
    return [
        F.lit(cfg.source).alias(cfg.field_source),
        space_key.alias(cfg.field_space_key),
        document_id.alias(cfg.field_document_id),
    ]


def add_space_key(docs: DataFrame, space_key: Column) -> DataFrame:
    """Put the space key into the document as ``spaceKey``, ahead of preprocessing."""
    return docs.withColumn("spaceKey", space_key)


def map_fields(docs: DataFrame, cfg: SyncConfig, space_key: Column | None = None) -> DataFrame:
    """The configured projection: three standard columns, the mapped fields, nothing else."""
    space = F.col("spaceKey") if space_key is None else space_key
    doc_id = simple_string(docs.schema, cfg.document_id)
    return docs.select(
        *standard_columns(cfg, space, doc_id),
        *mapped_columns(docs.schema, cfg.fields, cfg.value_filters),
    )


def document_json(*columns: Column | str) -> Column:
    """Stored body of a document: null values leave no key behind."""
    return F.to_json(F.struct(*columns))
