"""Documents with comments: four storage modes and the inverse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from syncspark.config import CommentMode, SyncConfig
from syncspark.errors import ConfigError
from syncspark.functions.paths import path_type, quoted, simple_string, struct_path, variant_list
from syncspark.operators.mapping import (
    document_json,
    map_fields,
    mapped_columns,
    standard_columns,
)


def _comments(docs: DataFrame, cfg: SyncConfig) -> tuple[Column, T.DataType] | None:
    kind = path_type(docs.schema, cfg.comments)
    if kind is None:
        return None
    if isinstance(kind, T.VariantType):
        value = struct_path(docs.schema, cfg.comments)
        wrong = F.raise_error(F.lit(f"'{cfg.comments}' must be an array of objects"))
        given = value.isNotNull() & ~F.is_variant_null(value)
        return F.when(given, F.coalesce(variant_list(value), wrong)), kind
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.VariantType))):
        raise ConfigError(f"'{cfg.comments}' must be an array of objects")
    return struct_path(docs.schema, cfg.comments), kind.elementType


def comment_id(schema: T.StructType, path: str, comment: Column, strict: bool = True) -> Column:
    """Id of a comment; a missing one fails the run, or is null when not ``strict``."""
    found = simple_string(schema, path, comment)
    if not strict:
        return found
    return F.when(found.isNull(), F.raise_error(F.lit("comment id not found"))).otherwise(found)


def embedded_comments(docs: DataFrame, cfg: SyncConfig) -> Column:
    """Array of mapped comments; null when the document has none."""
    found = _comments(docs, cfg)
    if found is None:
        return F.lit(None)
    values, kind = found
    mapped = F.transform(
        values, lambda c: F.struct(*mapped_columns(kind, cfg.comment_fields, cfg.value_filters, c))
    )
    return F.when(F.size(values) > 0, mapped)


def map_documents(docs: DataFrame, cfg: SyncConfig, space_key: Column | None = None) -> DataFrame:
    """Mapped documents; in embedded mode with their comments inside."""
    if cfg.comment_mode is not CommentMode.EMBEDDED:
        return map_fields(docs, cfg, space_key)
    space = F.col("spaceKey") if space_key is None else space_key
    return docs.select(
        *standard_columns(cfg, space, simple_string(docs.schema, cfg.document_id)),
        *mapped_columns(docs.schema, cfg.fields, cfg.value_filters),
        embedded_comments(docs, cfg).alias(cfg.field_comments),
    )


def comment_rows(docs: DataFrame, cfg: SyncConfig, space_key: Column | None = None) -> DataFrame:
    """One row per comment; the parent link is null in standalone mode."""
    found = _comments(docs, cfg)
    values, kind = found if found else (F.array().cast("array<struct<id:string>>"), T.StructType())
    space = F.col("spaceKey") if space_key is None else space_key
    doc_id = simple_string(docs.schema, cfg.document_id)
    exploded = docs.select(space.alias("_space"), doc_id.alias("_doc"), F.explode(values).alias("_comment"))
    comment = F.col("_comment")
    parent = F.col("_doc") if cfg.comment_mode is CommentMode.CHILD else F.lit(None).cast("string")
    return exploded.select(
        F.lit(cfg.comment_type).alias("doc_type"),
        comment_id(kind, cfg.comment_id, comment).alias("doc_id"),
        parent.alias("parent_id"),
        *standard_columns(cfg, F.col("_space"), F.col("_doc")),
        *mapped_columns(kind, cfg.comment_fields, cfg.value_filters, comment),
    )


def index_rows(
    docs: DataFrame, cfg: SyncConfig, space_key: Column | None = None, keep: list[str] = (), strict: bool = True
) -> DataFrame:
    """Target rows of a batch of documents in one pass over it.

    Columns: ``doc_type, doc_id, parent_id, source, space_key, document_id, body``
    plus the input columns named in ``keep``. A document and its comments leave the
    same task, so nothing is shuffled and the input is read once.
    """
    space = F.col("spaceKey") if space_key is None else space_key
    doc_id = simple_string(docs.schema, cfg.document_id)
    standard = standard_columns(cfg, space, doc_id)
    body = [*standard, *mapped_columns(docs.schema, cfg.fields, cfg.value_filters)]
    if cfg.comment_mode is CommentMode.EMBEDDED:
        body.append(embedded_comments(docs, cfg).alias(cfg.field_comments))

    def row(doc_type: str, row_id: Column, parent: Column, columns: list[Column]) -> Column:
        return F.struct(
            F.lit(doc_type).alias("doc_type"),
            row_id.alias("doc_id"),
            parent.cast("string").alias("parent_id"),
            document_json(*columns).alias("body"),
        )

    rows = F.array(row(cfg.doc_type, doc_id, F.lit(None), body))
    found = _comments(docs, cfg) if cfg.comment_mode.separate_rows else None
    if found:
        values, kind = found
        parent = doc_id if cfg.comment_mode is CommentMode.CHILD else F.lit(None)
        children = F.transform(
            values,
            lambda c: row(
                cfg.comment_type,
                comment_id(kind, cfg.comment_id, c, strict),
                parent,
                [*standard, *mapped_columns(kind, cfg.comment_fields, cfg.value_filters, c)],
            ),
        )
        rows = F.concat(rows, F.coalesce(children, F.slice(rows, 1, 0)))
    named = docs.select(
        F.lit(cfg.source).alias("source"),
        space.alias("space_key"),
        doc_id.alias("document_id"),
        *[F.col(quoted(name)) for name in keep],
        F.explode(rows).alias("_row"),
    )
    return named.select(
        "_row.doc_type", "_row.doc_id", "_row.parent_id", "source", "space_key", "document_id", "_row.body", *keep
    )


def lacks_comment_id(docs: DataFrame, cfg: SyncConfig) -> Column:
    """True for a document with a comment that cannot be stored under an id."""
    found = _comments(docs, cfg) if cfg.comment_mode.separate_rows else None
    if found is None:
        return F.lit(False)
    values, kind = found
    return F.coalesce(F.exists(values, lambda c: simple_string(kind, cfg.comment_id, c).isNull()), F.lit(False))


def collect_children(children: DataFrame, key: str | list[str], position: str, fields: list[str], name: str = "comments") -> DataFrame:
    """Fold child rows into one array per parent, ordered by ``position``: the inverse of
    child mode.

    A parent has one row whatever its size, as its document is one value. Where threads
    may outgrow a value, keep children as rows (child mode) and fold those asked for.
    """
    keys = [key] if isinstance(key, str) else list(key)
    item = F.struct(F.col(position), *[F.col(f) for f in fields if f != position])
    return children.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias(name))


def children_of(rows: DataFrame, comment_type: str, parent_id: str | None = None) -> DataFrame:
    """Comment rows that carry a parent link, or those of one parent."""
    linked = rows.filter((F.col("doc_type") == comment_type) & F.col("parent_id").isNotNull())
    return linked if parent_id is None else linked.filter(F.col("parent_id") == parent_id)
