from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from syncspark.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLE[run.__name__] = sql.strip()
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def at(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


def millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def text(column: str) -> Column:
    return F.col(column).cast("string")
