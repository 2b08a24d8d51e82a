"""Writes that tell accepted rows from refused ones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from syncspark.errors import ConfigError, WriteFailedError

REFUSED = "refused"


@dataclass
class WriteResult:
    written: int
    failed: int


def write_documents(rows: DataFrame, valid: Column, target: str, partition_by: list[str] = ()) -> WriteResult:
    """Append rows to ``target`` in one pass, accepted and refused ones in partitions of their own.

    The counts are taken from the rows on their way to the files, so the input is computed
    once. Partial failure is counted; total failure raises, with the refused rows kept.
    """
    if REFUSED in rows.columns:
        raise ConfigError(f"column '{REFUSED}' is taken by the sink")
    seen = Observation()
    marked = rows.withColumn(REFUSED, ~F.coalesce(valid, F.lit(False)))
    marked = marked.observe(seen, F.count("*").alias("total"), F.count_if(REFUSED).alias("failed"))
    marked.write.mode("append").partitionBy(REFUSED, *partition_by).parquet(target)
    total, failed = seen.get["total"], seen.get["failed"]
    if total and failed == total:
        raise WriteFailedError(f"none of {total} rows could be written")
    return WriteResult(total - failed, failed)


def stored(spark: SparkSession, target: str, schema: T.StructType, refused: bool = False) -> DataFrame:
    """The accepted or the refused rows of a target; the others' files are not read."""
    known = T.StructType([*schema.fields, T.StructField(REFUSED, T.BooleanType())])
    return spark.read.schema(known).parquet(target).filter(F.col(REFUSED) == F.lit(refused)).select(*schema.names)


def append_activity(runs: DataFrame, path: str | None) -> None:
    """Append run records; without a configured log nothing is written."""
    if path is not None:
        runs.write.mode("append").parquet(path)
