"""Run records and reports.

Run rows: ``source, space_key, full, start_date, documents_updated,
documents_deleted, comments_deleted, documents_with_error, ok, time_elapsed
(milliseconds), error_message``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from syncspark.functions.dates import parse_iso
from syncspark.functions.text import trim_to_null
from syncspark.operators.changes import latest

COUNTERS = ["documents_updated", "documents_deleted", "comments_deleted", "documents_with_error"]
RECORD_SCHEMA = (
    "source string, space_key string, update_type string, start_date string, documents_updated int, "
    "documents_deleted int, comments_deleted int, documents_with_error int, result string, "
    "time_elapsed string, error_message string"
)


def iso_millis(ts: Column) -> Column:
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def record_fields(final: bool = True) -> list[Column]:
    """Fields of a run record; a run still going has no final status."""
    fields = [
        F.when(F.col("full"), "FULL").otherwise("INCREMENTAL").alias("update_type"),
        iso_millis(F.col("start_date")).alias("start_date"),
        *[F.col(name).cast("int").alias(name) for name in COUNTERS],
    ]
    if final:
        fields += [
            F.when(F.col("ok"), "OK").otherwise("ERROR").alias("result"),
            F.concat(F.col("time_elapsed").cast("string"), F.lit("ms")).alias("time_elapsed"),
            trim_to_null(F.col("error_message")).alias("error_message"),
        ]
    return fields


def activity_row(runs: DataFrame) -> DataFrame:
    """The record appended to the activity log."""
    return runs.select("source", "space_key", *record_fields())


def activity_json(runs: DataFrame) -> DataFrame:
    """The record as stored text; absent values leave no key."""
    return runs.select(F.to_json(F.struct("source", "space_key", *record_fields())).alias("record"))


def run_rows(records: DataFrame) -> DataFrame:
    """Run rows out of activity records, the inverse of ``activity_row``."""
    return records.select(
        "source",
        "space_key",
        F.col("update_type").eqNullSafe("FULL").alias("full"),
        parse_iso(F.col("start_date")).alias("start_date"),
        *COUNTERS,
        F.col("result").eqNullSafe("OK").alias("ok"),
        F.regexp_replace("time_elapsed", "ms", "").cast("bigint").alias("time_elapsed"),
        trim_to_null(F.col("error_message")).alias("error_message"),
    )


def parse_activity_row(records: DataFrame, column: str = "record") -> DataFrame:
    """Run rows read back from stored text."""
    return run_rows(records.select(F.from_json(column, RECORD_SCHEMA).alias("r")).select("r.*"))


def last_run(runs: DataFrame) -> DataFrame:
    """Newest run per source and space."""
    return latest(runs, ["source", "space_key"], ["start_date"])


def state_report(sources: DataFrame, running: DataFrame, spaces: DataFrame, runs: DataFrame) -> DataFrame:
    """State of sources as rows of ``source, section, space_key, report``.

    ``sources``: source, info_date, state, since. One ``source`` row per source, one
    ``current_indexing`` row per run that is going on, one ``indexed_spaces`` row per
    space, also for spaces that never ran. Rows instead of one document keep the size
    of a report independent of the number of spaces.
    """
    since = F.when(F.col("state") == "stopped", "stopped_permanently").otherwise("last_restart")
    head = sources.select(
        "source",
        F.lit("source").alias("section"),
        F.lit(None).cast("string").alias("space_key"),
        F.to_json(
            F.struct(
                "source",
                iso_millis(F.col("info_date")).alias("info_date"),
                F.col("state"),
                F.when(since == "last_restart", iso_millis(F.col("since"))).alias("last_restart"),
                F.when(since == "stopped_permanently", iso_millis(F.col("since"))).alias("stopped_permanently"),
            )
        ).alias("report"),
    )
    current = running.select(
        "source",
        F.lit("current_indexing").alias("section"),
        "space_key",
        F.to_json(F.struct("space_key", *record_fields(final=False))).alias("report"),
    )
    newest = last_run(runs).select("source", "space_key", F.struct(*record_fields()).alias("last_indexing"))
    each = spaces.select("source", "space_key").join(newest, ["source", "space_key"], "left").select(
        "source",
        F.lit("indexed_spaces").alias("section"),
        "space_key",
        F.to_json(F.struct("space_key", "last_indexing")).alias("report"),
    )
    return head.unionByName(current).unionByName(each)


def list_sources(rows: DataFrame) -> DataFrame:
    return rows.select("source").distinct()
