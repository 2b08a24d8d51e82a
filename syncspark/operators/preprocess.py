"""Document transforms that run before mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from syncspark.functions.paths import path_type, put_path, struct_path
from syncspark.operators.joins import keyed_join

Preprocessor = Callable[[DataFrame], DataFrame]


def preprocess(docs: DataFrame, chain: Iterable[Preprocessor | None]) -> DataFrame:
    """Run the transforms in order; empty entries are skipped."""
    return reduce(lambda df, step: df.transform(step), [step for step in chain if step is not None], docs)


def value_map(source_field: str, target_field: str, mapping: dict[str, str], default: str | None = None) -> Preprocessor:
    """Normalise a value by a table of the configuration, with a default for the rest."""

    def run(docs: DataFrame) -> DataFrame:
        value = struct_path(docs.schema, source_field).cast("string")
        mapped = F.lit(None).cast("string")
        if mapping:
            mapped = F.create_map(*[F.lit(item) for pair in mapping.items() for item in pair])[value]
        return put_path(docs, target_field, F.coalesce(mapped, F.lit(default)))

    return run


def lookup(source_field: str, table: DataFrame, key: str, values: dict[str, str]) -> Preprocessor:
    """Normalise a value by another dataset, which has one row per ``key``.

    ``values`` maps target fields of the document to columns of the dataset.
    """

    def run(docs: DataFrame) -> DataFrame:
        held = {target: f"_lookup_{i}" for i, target in enumerate(values)}
        value, wanted = struct_path(docs.schema, source_field), F.col(key)
        if isinstance(path_type(docs.schema, source_field), T.VariantType):
            value, wanted = value.try_cast("string"), wanted.cast("string")
        side = table.select(wanted.alias("_key"), *[F.col(values[t]).alias(c) for t, c in held.items()])
        joined = keyed_join(docs.withColumn("_key", value), side, ["_key"], "left", hot=True)
        for target, column in held.items():
            joined = put_path(joined, target, F.col(column))
        return joined.drop("_key", *held.values())

    return run


def constant(target_field: str, value: object) -> Preprocessor:
    return lambda docs: put_path(docs, target_field, F.lit(value))


def combine(target_field: str, *source_fields: str) -> Preprocessor:
    """Distinct non-null values of several fields as one array."""

    def run(docs: DataFrame) -> DataFrame:
        found: list[Column] = [struct_path(docs.schema, name).cast("string") for name in source_fields]
        return put_path(docs, target_field, F.array_distinct(F.array_compact(F.array(*found))))

    return run
