"""Applying changed documents to a target of indexed rows.

Target rows: ``doc_type, doc_id, parent_id, source, space_key, document_id, body,
indexed_at``. A row is keyed by ``(doc_type, doc_id)``; a delete is scoped by
``(source, space_key, document_id)``. Write times are arguments, so a repeated run
gives the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from syncspark.config import SyncConfig
from syncspark.functions.dates import parse_datetime
from syncspark.functions.paths import (
    document_deleted,
    document_id,
    path_type,
    require_document_id,
    simple_string,
    struct_path,
)
from syncspark.operators.comments import index_rows
from syncspark.operators.joins import keyed_join

ROW_KEY = ["doc_type", "doc_id"]
DELETE_SCOPE = ["source", "space_key", "document_id"]


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key.

    An aggregate, not a window: every task reduces its rows to one per key before
    the shuffle, so a key with a large share of the rows costs one row per task.
    """
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*order))
    return rows.groupBy(*keys).agg(newest.alias("_newest")).select(*keys, "_newest.*").select(*rows.columns)


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Whole rows replaced by key, last write wins."""
    newest = latest(changes, keys, order)
    kept = keyed_join(target, newest.select(*keys), keys, "left_anti")
    return kept.unionByName(newest.select(*target.columns))


def flagged_delete(target: DataFrame, deletes: DataFrame, doc_types: list[str]) -> DataFrame:
    """Target without the rows of deleted documents, their comments included."""
    scoped = F.col("doc_type").isin(*doc_types)
    keys = deletes.select(*DELETE_SCOPE).distinct()
    return target.filter(~scoped).unionByName(keyed_join(target.filter(scoped), keys, DELETE_SCOPE, "left_anti"))


def removed_by(target: DataFrame, deletes: DataFrame, doc_types: list[str]) -> DataFrame:
    """Target rows a flagged delete takes away."""
    keys = deletes.select(*DELETE_SCOPE).distinct()
    return keyed_join(target.filter(F.col("doc_type").isin(*doc_types)), keys, DELETE_SCOPE, "left_semi")


def is_stale(source: str, spaces: list[str] | None, run_start: datetime, doc_types: list[str]) -> Column:
    """True for rows of the refreshed source and spaces not written since the run began."""
    scope = (F.col("source") == source) & F.col("doc_type").isin(*doc_types)
    if spaces is not None:
        scope = scope & F.col("space_key").isin(*spaces)
    return scope & (F.col("indexed_at") < F.lit(run_start))


def stale_delete(target: DataFrame, source: str, spaces: list[str] | None, run_start: datetime, doc_types: list[str]) -> DataFrame:
    return target.filter(~is_stale(source, spaces, run_start, doc_types))


def delete_counters(removed: DataFrame, doc_type: str) -> DataFrame:
    """Removed parent and child rows per space."""
    parent = F.col("doc_type") == doc_type
    return removed.groupBy("source", "space_key").agg(
        F.count_if(parent).alias("documents_deleted"),
        F.count_if(~parent).alias("comments_deleted"),
    )


def document_updated(schema: T.StructType, path: str, fmt: str | None = None, strict: bool = True) -> Column:
    """Update time of a document, null when absent; unreadable text fails the run, or
    is null when not ``strict``."""
    if isinstance(path_type(schema, path), (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return struct_path(schema, path).cast("timestamp")
    return parse_datetime(simple_string(schema, path), fmt, strict)


def require_updated(updated: Column, doc_id: Column) -> Column:
    """The update time itself; a missing one fails the run."""
    message = F.concat(F.lit("last update time not found in data of document "), F.coalesce(doc_id, F.lit("?")))
    return F.when(updated.isNull(), F.raise_error(message)).otherwise(updated)


@dataclass
class Changes:
    """A batch of changed documents split into rows to write and documents to drop."""

    upserts: DataFrame
    deletes: DataFrame


def split_changes(docs: DataFrame, cfg: SyncConfig, order: list[str], space_key: Column | None = None) -> Changes:
    """Turn documents into target rows and deletes, both carrying ``order``."""
    space = F.col("spaceKey") if space_key is None else space_key
    checked = docs
    if "." not in cfg.document_id and cfg.document_id in docs.columns:
        checked = docs.withColumn(
            cfg.document_id, require_document_id(document_id(docs.schema, cfg.document_id), space)
        )
    flag = document_deleted(docs.schema, cfg.deleted, cfg.deleted_value)
    upserts = index_rows(checked.filter(~flag), cfg, space, keep=order)
    deletes = checked.filter(flag).select(
        F.lit(cfg.source).alias("source"),
        space.alias("space_key"),
        document_id(checked.schema, cfg.document_id).alias("document_id"),
        *order,
    )
    return Changes(upserts, deletes)


def apply_changes(
    target: DataFrame, changes: Changes, order: list[str], indexed_at: datetime, doc_types: list[str]
) -> DataFrame:
    """Target after a batch, in arrival order: upserts replace, deletes remove.

    Comments of an older version that the new version lacks stay, as only a delete
    or a full refresh removes them.
    """
    newest = latest(changes.upserts, ROW_KEY, order)
    drop = changes.deletes.groupBy(*DELETE_SCOPE).agg(F.max(F.struct(*order)).alias("_deleted"))
    alive = (
        keyed_join(newest, drop, DELETE_SCOPE, "left")
        .filter(F.col("_deleted").isNull() | (F.struct(*order) > F.col("_deleted")))
        .withColumn("indexed_at", F.lit(indexed_at))
    )
    kept = keyed_join(target, newest.select(*ROW_KEY), ROW_KEY, "left_anti")
    kept = flagged_delete(kept, changes.deletes, doc_types)
    return kept.unionByName(alive.select(*target.columns))


def full_refresh(
    target: DataFrame, changes: Changes, order: list[str], run_start: datetime, source: str,
    spaces: list[str] | None, doc_types: list[str],
) -> DataFrame:
    """A full run: the batch applied, then everything it did not write removed."""
    applied = apply_changes(target, changes, order, run_start, doc_types)
    return stale_delete(applied, source, spaces, run_start, doc_types)


def effective_kind(spaces: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Kind of run per space: without a stored watermark an incremental run is a full one.

    ``spaces``: source, space_key, full (requested). ``watermarks``: source, space_key,
    watermark, one row per space.
    """
    return with_effective_kind(spaces.join(watermarks, ["source", "space_key"], "left"))


def with_effective_kind(spaces: DataFrame) -> DataFrame:
    """The same for spaces that have their ``watermark`` at hand."""
    after = F.when(~F.col("full"), F.col("watermark"))
    full = F.col("full") | F.col("watermark").isNull()
    return spaces.select("source", "space_key", full.alias("full"), after.alias("updated_after"))


def watermark_advance(read: DataFrame) -> DataFrame:
    """Watermark per space after a run.

    ``read``: source, space_key, page_no, pos, updated, reachable, wrote. Each page
    offers the update time of its last reachable document in page order, and only
    pages that wrote or deleted something count.
    """
    keys = ["source", "space_key"]
    seen = F.when(F.col("reachable"), F.col("pos"))
    pages = read.groupBy(*keys, "page_no").agg(
        F.max_by("updated", seen).alias("_updated"),
        F.bool_or(F.col("reachable") & F.col("wrote")).alias("_wrote"),
    )
    return pages.groupBy(*keys).agg(
        F.max_by("_updated", F.when(F.col("_wrote"), F.col("page_no"))).alias("watermark"),
        F.bool_or("_wrote").alias("_any"),
    ).filter("_any").drop("_any")


def watermark_bump(start: Column, end: Column, updated: Column) -> Column:
    """One second more when a run re-read only what it already had."""
    stuck = (start == end) & (updated > 0)
    return F.when(stuck, end + F.lit(timedelta(seconds=1))).otherwise(end)


def run_counters(read: DataFrame) -> DataFrame:
    """Counters of a run per space in one aggregate.

    ``read``: source, space_key, reachable, deleted, rejected (write refused).
    """
    written = F.col("reachable") & ~F.col("deleted")
    return read.groupBy("source", "space_key").agg(
        F.count_if(written & ~F.col("rejected")).alias("documents_updated"),
        F.count_if(~F.col("reachable") | (written & F.col("rejected"))).alias("documents_with_error"),
        F.count_if(F.col("reachable") & F.col("deleted")).alias("documents_flagged"),
    )


def run_outcome(runs: DataFrame, errors: DataFrame) -> DataFrame:
    """Result, elapsed time and messages of runs.

    ``runs``: source, space_key, start_date, end_date, failure (message of a run that
    broke off, else null). ``errors``: source, space_key, message of skipped documents.
    Equal messages are counted before they meet in one row, and a run shows its most
    frequent ones; the failing documents themselves stay in ``errors``.
    """
    keys = ["source", "space_key"]
    kinds = (
        errors.select(*keys, F.trim("message").alias("message")).filter("message <> ''")
        .groupBy(*keys, "message").agg(F.count("*").alias("_times"))
    )
    counts = kinds.groupBy(*keys).agg(F.sum("_times").alias("documents_with_error"))
    texts = frequent_messages(kinds.withColumnRenamed("_times", "n"), keys)
    joined = runs.join(counts, keys, "left").join(texts, keys, "left")
    failure = F.nullif(F.trim("failure"), F.lit(""))
    lines = F.array_compact(F.array("messages", failure))
    return joined.select(
        *keys,
        F.when(F.col("failure").isNull(), "OK").otherwise("ERROR").alias("result"),
        (F.unix_millis(F.col("end_date").cast("timestamp")) - F.unix_millis(F.col("start_date").cast("timestamp"))).alias("time_elapsed"),
        F.coalesce("documents_with_error", F.lit(0)).cast("bigint").alias("documents_with_error"),
        F.nullif(F.array_join(lines, "\n"), F.lit("")).alias("error_message"),
    )


MESSAGES = 20


def frequent_messages(kinds: DataFrame, keys: list[str], most: int = MESSAGES) -> DataFrame:
    """Per key the ``most`` frequent messages in the order of their text, and how many more there are.

    ``kinds``: the keys, message and n. Every task keeps its own most frequent ones, so any
    number of different messages meets as a few rows.
    """
    each = kinds.filter("message is not null").groupBy(*keys, "message").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(*keys).orderBy(F.desc("n"), "message")
    top = each.withColumn("_i", F.row_number().over(order)).filter(F.col("_i") <= most)
    lines = top.groupBy(*keys).agg(F.array_sort(F.collect_list("message")).alias("_lines"))
    total = each.groupBy(*keys).agg(F.count("*").alias("_kinds"))
    more = F.when(F.col("_kinds") > most, F.array(F.format_string("and %d more kinds of messages", F.col("_kinds") - most))).otherwise(F.array().cast("array<string>"))
    return lines.join(total, keys).select(*keys, F.array_join(F.concat("_lines", more), "\n").alias("messages"))


def gapless_end(slices: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the longest run of finished slices from the first on: how many, and where it ends.

    ``slices``: the keys, slice (from 0), finished, updated_before; they may end in any order,
    and one that is there twice is finished when it is so once.
    """
    done = slices.filter("finished").groupBy(*keys, "slice").agg(F.max("updated_before").alias("updated_before"))
    island = F.col("slice") - F.row_number().over(Window.partitionBy(*keys).orderBy("slice"))
    return done.withColumn("_island", island).filter("_island = -1").groupBy(*keys).agg(
        F.count("*").alias("finished"), F.max_by("updated_before", "slice").alias("updated_before")
    )


def snapshot_diff(before: DataFrame, after: DataFrame, keys: list[str], compared: list[str]) -> DataFrame:
    """Rows added, changed, unchanged and removed between two snapshots.

    One aggregate over both sides instead of a full outer join: a single shuffle of
    keys and hashes, reduced per task first. Keys are unique within a snapshot.
    """
    digest = F.xxhash64(*compared)
    sides = before.select(*keys, digest.alias("_old"), F.lit(None).cast("bigint").alias("_new")).unionByName(
        after.select(*keys, F.lit(None).cast("bigint").alias("_old"), digest.alias("_new"))
    )
    paired = sides.groupBy(*keys).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    status = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(F.col("_old") == F.col("_new"), "unchanged")
        .otherwise("changed")
    )
    return paired.select(*keys, status.alias("status"))
