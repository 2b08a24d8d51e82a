"""Joins against a side that is usually, but not surely, small."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a side before it is broadcast; nested values count by their text."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    width = F.lit(8 * len(df.columns)).cast("bigint")
    for name in texts:
        width = width + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
        elif isinstance(f.dataType, T.VariantType):
            width = width + F.coalesce(F.octet_length(F.to_json(F.col(f"`{f.name}`"))), F.lit(0))
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def keyed_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, hot: bool = False) -> DataFrame:
    """Join ``left`` with a ``right`` that has one row per key.

    A right side of measured small size is broadcast, so the left one stays where it
    is. Beyond that both sides are shuffled, and Spark splits a partition that turns
    out skewed. With ``hot``, for joins on few and very uneven keys such as spaces,
    the shuffle is on key and salt instead: every left row goes to one of ``SALTS``
    tasks of its key. The salt is a function of the row and its partition, hence the
    same on a retry.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    if is_small(right):
        return left.join(F.broadcast(right), keys, how)
    if not hot:
        return left.join(right, keys, how)
    plain = [f.name for f in left.schema.fields if isinstance(f.dataType, (T.NumericType, T.StringType, T.TimestampType, T.TimestampNTZType))]
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]) + F.spark_partition_id(), F.lit(SALTS))
    salted_left = left.withColumn("_salt", salt.cast("int"))
    salted_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")
