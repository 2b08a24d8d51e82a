"""Details fetched per document."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

NOT_FOUND = 404


def enrich_details(docs: DataFrame, details: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Documents with ``detail`` attached, and the errors of those not found.

    ``details``: the keys, status, detail, one row per document that was asked for. A
    null detail or no row leaves the document without one; a document that was not
    found is dropped and counted.
    """
    marked = reachable(docs, details, keys)
    errors = marked.filter(~F.col("reachable")).select(
        *keys, F.lit(SKIPPED).alias("message")
    )
    return marked.filter("reachable").drop("reachable"), errors


SKIPPED = "detail processing problem, document skipped: not found"


def mark_skipped(docs: DataFrame, details: DataFrame, keys: list[str]) -> DataFrame:
    """All documents with ``detail``; those not found carry a ``skip_reason``, which a
    pass counts as an error instead of storing the document."""
    marked = reachable(docs, details, keys)
    return marked.withColumn("skip_reason", F.when(~F.col("reachable"), F.lit(SKIPPED))).drop("reachable")


def reachable(docs: DataFrame, details: DataFrame, keys: list[str]) -> DataFrame:
    """All documents with ``detail`` and whether it could be had.

    Both sides are as large as the documents, so this is a plain equi join: Spark
    picks the strategy from the statistics and splits a skewed key at run time.
    """
    side = details.select(*keys, F.col("status").alias("_status"), "detail")
    joined = docs.join(side, keys, "left")
    return joined.withColumn("reachable", F.coalesce(F.col("_status") != NOT_FOUND, F.lit(True))).drop("_status")
