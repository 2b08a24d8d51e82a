"""Dot paths into nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from syncspark.errors import ConfigError, DataShapeError

# Types whose values may serve as an id, a flag or a timestamp.
SIMPLE_TYPES = (
    T.StringType,
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.TimestampType,
    T.TimestampNTZType,
    T.DateType,
)
SIMPLE_VARIANT_TYPES = ("STRING", "BIGINT", "BOOLEAN", "TIMESTAMP", "TIMESTAMP_NTZ", "DATE")


def quoted(path: str) -> str:
    """``a.b`` with every level back-quoted, so odd field names stay usable."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in path.split("."))


def path_type(schema: T.StructType, path: str) -> T.DataType | None:
    """Type a path resolves to, or None when a level is missing.

    A step into an array of objects yields an array of the member values. A step into
    VARIANT yields VARIANT, as what is there differs from row to row.
    """
    current: T.DataType = schema
    arrays = 0
    for part in path.split("."):
        while isinstance(current, T.ArrayType):
            current, arrays = current.elementType, arrays + 1
        if isinstance(current, T.VariantType):
            break
        if isinstance(current, T.MapType):
            current = current.valueType
        elif isinstance(current, T.StructType) and part in current.names:
            current = current[part].dataType
        else:
            return None
    for _ in range(arrays):
        current = T.ArrayType(current)
    return current


def struct_path(schema: T.StructType, path: str, root: Column | None = None) -> Column:
    """Value at ``path``; a missing field is null instead of an analysis error."""
    if path_type(schema, path) is None:
        return F.lit(None)
    parts = path.split(".")
    typed, arrays = _typed_steps(schema, parts)
    if root is None:
        value = F.col(quoted(".".join(parts[:typed])))
    else:
        value = root
        for part in parts[:typed]:
            value = value[part]
    if typed == len(parts):
        return value
    return _inside(value, arrays, lambda item: variant_member(item, parts[typed:]))


def _typed_steps(schema: T.DataType, parts: list[str]) -> tuple[int, int]:
    """How many steps lead to the first VARIANT (all, if there is none), and through how
    many arrays."""
    for i in range(len(parts)):
        kind, arrays = path_type(schema, ".".join(parts[:i])) if i else schema, 0
        while isinstance(kind, T.ArrayType):
            kind, arrays = kind.elementType, arrays + 1
        if isinstance(kind, T.VariantType):
            return i, arrays
    return len(parts), 0


def _inside(value: Column, arrays: int, step) -> Column:
    if not arrays:
        return step(value)
    return F.transform(value, lambda item: _inside(item, arrays - 1, step))


def json_path(parts: list[str]) -> str:
    """Steps as a path into VARIANT."""
    steps = []
    for part in parts:
        quote = "'" if '"' in part else '"'
        steps.append(f"[{quote}{part}{quote}]" if "[" in part else f".{part}")
    return "$" + "".join(steps)


def variant_path(doc: Column, path: str, as_type: str = "string") -> Column:
    """Value at ``path`` of a VARIANT document; missing or unconvertible is null."""
    return F.try_variant_get(doc, json_path(path.split(".")), as_type)


def variant_member(value: Column, parts: list[str], listed: bool = False) -> Column:
    """Member of a VARIANT as VARIANT; missing is null.

    As with typed arrays, a list on the way yields the list of its objects' members, with
    a null for an object that lacks it. Lists directly in lists are not entered.
    """
    found = [F.try_variant_get(value, json_path(parts), "variant")]
    for i in range(1 if listed else 0, len(parts)):
        items = F.try_variant_get(value, json_path(parts[:i]), "array<variant>")
        members = F.transform(items, lambda item: variant_member(item, parts[i:], listed=True))
        found.append(F.when(items.isNotNull(), F.to_variant_object(members)))
    return F.coalesce(*found)


def variant_object(value: Column) -> Column:
    """Members of a VARIANT object as a map; null for anything else."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def variant_list(value: Column) -> Column:
    """Items of a VARIANT list; null for anything else."""
    return F.try_variant_get(value, "$", "array<variant>")


def as_variant(value: Column) -> Column:
    """Any value as VARIANT, nested ones too."""
    return F.try_variant_get(F.to_variant_object(F.array(value)), "$[0]", "variant")


def is_simple(value: Column) -> Column:
    """True when a VARIANT holds a string, whole number, boolean or date."""
    return F.schema_of_variant(value).isin(*SIMPLE_VARIANT_TYPES)


def simple_string(schema: T.StructType, path: str, root: Column | None = None) -> Column:
    """A simple value as text; a double, object or list is a configuration error."""
    found = path_type(schema, path)
    if found is None or isinstance(found, T.NullType):
        return F.lit(None).cast("string")
    if isinstance(found, T.VariantType):
        value = struct_path(schema, path, root)
        return F.when(value.isNull() | (F.schema_of_variant(value) == "VOID"), F.lit(None)).when(
            is_simple(value), value.cast("string")
        ).otherwise(F.raise_error(F.lit(f"field '{path}' must provide a simple value")))
    if not isinstance(found, SIMPLE_TYPES):
        raise ConfigError(f"field '{path}' must provide a simple value, but is {found.simpleString()}")
    return struct_path(schema, path, root).cast("string")


def document_id(schema: T.StructType, path: str) -> Column:
    return simple_string(schema, path)


def require_document_id(doc_id: Column, space_key: Column) -> Column:
    """The id itself; a null or blank one fails the run."""
    blank = doc_id.isNull() | (F.trim(doc_id) == "")
    message = F.concat(F.lit("document id not found in data of space "), F.coalesce(space_key, F.lit("?")))
    return F.when(blank, F.raise_error(message)).otherwise(doc_id)


def document_deleted(schema: T.StructType, path: str | None, deleted_value: str | None) -> Column:
    """Case-sensitive comparison of the flag's text with the configured value."""
    if path is None:
        return F.lit(False)
    return F.coalesce(simple_string(schema, path) == F.lit(deleted_value), F.lit(False))


def put_path(df: DataFrame, path: str, value: Column) -> DataFrame:
    """Set a nested value, creating the missing levels."""
    if not path or not path.strip():
        raise DataShapeError("a field path must be given")
    head, *rest = path.split(".")
    known = head in df.columns
    column = F.col(quoted(head)) if known else None
    kind = df.schema[head].dataType if known else None
    return df.withColumn(head, _put(column, kind, rest, value, path))


def _put(column, kind, rest, value, path):
    if not rest:
        return value
    if isinstance(kind, T.VariantType):
        return _put_variant(column, rest, value, path)
    fields = []
    if kind is not None and not isinstance(kind, T.NullType):
        if not isinstance(kind, T.StructType):
            raise DataShapeError(f"cannot set '{path}': an element on the way is not an object")
        fields = list(kind.fields)
    kept = [(f.name, column[f.name], f.dataType) for f in fields]
    if rest[0] not in [name for name, _, _ in kept]:
        kept.append((rest[0], None, None))
    return F.struct(
        *[
            (_put(sub, sub_kind, rest[1:], value, path) if name == rest[0] else sub).alias(name)
            for name, sub, sub_kind in kept
        ]
    )


def _put_variant(column, rest, value, path):
    empty = variant_object(F.parse_json(F.lit("{}")))
    wrong = F.raise_error(F.lit(f"cannot set '{path}': an element on the way is not an object"))
    absent = column.isNull() | F.is_variant_null(column)
    members = F.when(absent, empty).otherwise(F.coalesce(variant_object(column), wrong))
    new = value if len(rest) == 1 else _put_variant(members[rest[0]], rest[1:], value, path)
    others = F.map_filter(members, lambda name, _: name != rest[0])
    return F.to_variant_object(F.map_concat(others, F.create_map(F.lit(rest[0]), as_variant(new))))
