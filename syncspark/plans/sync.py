"""One pass of a synchronisation over every due space, as a single Spark plan."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from syncspark.config import ReadMode, SyncConfig
from syncspark.errors import DataShapeError
from syncspark.functions.paths import document_deleted, document_id, path_type
from syncspark.functions.text import is_blank
from syncspark.operators import activity as act, sinks, state as st
from syncspark.operators.changes import (
    DELETE_SCOPE,
    ROW_KEY,
    delete_counters,
    document_updated,
    frequent_messages,
    require_document_id,
    require_updated,
    watermark_bump,
    with_effective_kind,
)
from syncspark.operators.activity import COUNTERS
from syncspark.operators.comments import index_rows, lacks_comment_id
from syncspark.operators.joins import keyed_join
from syncspark.operators.preprocess import Preprocessor, preprocess
from syncspark.plans.store import ROWS_PARTITIONS, SyncStore
from syncspark.sources.paged import SLICE_BITS
from syncspark.sources.spaces import select_spaces

# A reader gets the spaces to read (source, space_key, full, updated_after) and returns
# documents with spaceKey, page_no and pos.
Reader = Callable[[DataFrame], DataFrame]


@dataclass
class RunReport:
    run_id: int
    runs: DataFrame


def target_rows(docs: DataFrame, cfg: SyncConfig, indexed_at: datetime, run_id: int, strict: bool = True) -> DataFrame:
    """Rows to store for a batch, read once: versions of documents and comments, one
    delete row per flagged document, one ``skipped`` row per document with a
    ``skip_reason``.

    A document without id or update time, or with a comment without id, fails the
    batch when ``strict``; else it becomes an ``error`` row, for which only its space
    fails. A row with a ``request_error`` becomes a ``gap``: what its request would have
    read is missing.
    """
    space = F.col("spaceKey")
    doc_id = document_id(docs.schema, cfg.document_id)
    updated, timely = F.lit(None).cast("timestamp"), F.lit(True)
    if cfg.updated is not None:
        updated = document_updated(docs.schema, cfg.updated, cfg.updated_format, strict)
        timely = updated.isNotNull() if cfg.read_mode is ReadMode.UPDATE_TIMESTAMP else timely
    if strict:
        doc_id = require_document_id(doc_id, space)
        updated = require_updated(updated, doc_id) if cfg.read_mode is ReadMode.UPDATE_TIMESTAMP else updated
        error = F.lit(None).cast("string")
    else:
        error = (
            F.when(is_blank(doc_id), F.concat(F.lit("document id not found in data of space "), space))
            .when(~timely, F.concat(F.lit("last update time not found in data of document "), doc_id))
            .when(lacks_comment_id(docs, cfg), F.concat(F.lit("comment id not found in data of document "), doc_id))
        )
    gap = F.col("request_error") if "request_error" in docs.columns else F.lit(None).cast("string")
    skip = F.col("skip_reason") if "skip_reason" in docs.columns else F.lit(None).cast("string")
    flagged = docs.select(
        "*",
        updated.alias("_updated"),
        doc_id.alias("_checked"),
        F.when(gap.isNotNull(), "gap").when(skip.isNotNull() & ~is_blank(doc_id), "skipped").when(error.isNotNull(), "error")
        .when(document_deleted(docs.schema, cfg.deleted, cfg.deleted_value), "delete").otherwise("upsert").alias("_op"),
        F.coalesce(gap, skip, error).alias("_message"),
    )
    rows = index_rows(flagged, cfg, keep=["_updated", "_checked", "_op", "_message", "page_no", "pos"], strict=strict)
    own, stored = F.col("doc_type") == cfg.doc_type, F.col("_op") == "upsert"
    return rows.filter(stored | own).select(
        "doc_type",
        F.when(own, F.col("_checked")).otherwise(F.col("doc_id")).alias("doc_id"),
        "parent_id",
        F.col("_checked").alias("document_id"),
        F.when(stored, F.col("body")).otherwise(F.col("_message")).alias("body"),
        F.col("_updated").alias("updated"),
        F.lit(indexed_at).alias("indexed_at"),
        F.col("page_no").cast("bigint").alias("page_no"),
        F.col("pos").cast("bigint").alias("pos"),
        "source",
        "space_key",
        F.lit(None).cast("bigint").alias("at_run"),
        F.lit(run_id).cast("bigint").alias("run_id"),
        F.col("_op").alias("op"),
    )


def _counters(
    store: SyncStore, cfg: SyncConfig, before_runs: DataFrame, kinds: DataFrame, run_id: int, some_full: bool, some_partial: bool
) -> DataFrame:
    """Counters per space: what the run wrote, and what it takes from the target.

    Of the target, only the documents that an incremental run deletes are looked at, and
    the spaces that a full run restarts.
    """
    keys = ["source", "space_key"]
    written = store.rows().filter(F.col("run_id") == run_id)
    joined = kinds.join(_written(store, written, cfg, run_id), keys, "left")
    removed = []
    of_source = F.col("doc_type").isin(*cfg.doc_types)

    def taken(full: bool, only: DataFrame | None) -> DataFrame:
        spaces = kinds.filter(F.col("full") == F.lit(full)).select(*keys)
        runs = before_runs.join(spaces, keys, "left_semi")
        return store.current(columns=[], runs=runs, only=only).filter(of_source)

    if some_partial:
        deletes = written.filter("op = 'delete'").select(*DELETE_SCOPE).distinct()
        if not deletes.isEmpty():
            removed.append(taken(False, deletes))
    if some_full:
        # Both sides are of the size of the target, so neither is worth measuring.
        fresh = written.filter("op = 'upsert'").select(*ROW_KEY)
        removed.append(taken(True, None).join(fresh, ROW_KEY, "left_anti"))
    if removed:
        rows = reduce(DataFrame.unionByName, [r.select(*keys, "doc_type") for r in removed])
        joined = joined.join(delete_counters(rows, cfg.doc_type), keys, "left")
    else:
        joined = joined.withColumns({c: F.lit(0).cast("bigint") for c in ("documents_deleted", "comments_deleted")})
    # A full run that could not read all would take what it missed for removed.
    failure = F.coalesce("failure", F.when(F.col("full"), F.col("gap")))
    ok = failure.isNull()
    counted = [F.when(ok, F.coalesce(c, F.lit(0))).otherwise(0).cast("bigint").alias(c) for c in COUNTERS]
    return joined.select(
        *keys, "full", *counted, ok.alias("ok"), F.coalesce(failure, F.col("skips")).alias("error_message"),
        F.when(ok & F.col("gap").isNotNull(), F.col("watermark"))
        .when(ok, watermark_bump(F.col("updated_after"), F.col("watermark"), F.col("documents_updated"))).alias("watermark"),
    )


def _written(store: SyncStore, written: DataFrame, cfg: SyncConfig, run_id: int) -> DataFrame:
    """Per space: stored and skipped documents, the most frequent messages, the first failure,
    the first gap, and the update time of the last stored document in page order before it.

    Rows are first reduced to one per kind, slice and message; these are kept in the table
    ``messages``, so the report needs to hold a few lines only.
    """
    keys = ["source", "space_key"]
    said = F.when(F.col("op").isin("skipped", "gap"), F.col("body"))
    failure = F.when(F.col("op") == "error", F.struct("page_no", "pos", "body"))
    gap = F.when(F.col("op") == "gap", F.struct("page_no", "pos", "body"))
    last = F.when(F.col("op").isin("upsert", "delete"), F.struct("page_no", "pos", "updated"))
    part = F.shiftright(F.coalesce("page_no", F.lit(0)), SLICE_BITS)
    kinds = written.filter(F.col("doc_type") == cfg.doc_type).groupBy(*keys, "op", part.alias("slice"), said.alias("message")).agg(
        F.count("*").alias("n"), F.min(failure).alias("failure"), F.min(gap).alias("gap"), F.max(last).alias("last")
    )
    kinds = store.save(kinds, "messages", run_id)
    gaps = kinds.groupBy(*keys).agg(F.min("gap").alias("_gap"), F.min(F.when(F.col("op") == "gap", F.col("slice"))).alias("_until"))
    gaps = gaps.filter("_gap is not null")
    read = F.col("_until").isNull() | (F.col("slice") <= F.col("_until"))
    return kinds.join(gaps, keys, "left").groupBy(*keys).agg(
        F.sum(F.when(F.col("op") == "upsert", F.col("n"))).alias("documents_updated"),
        F.sum(F.when(F.col("op") == "skipped", F.col("n"))).alias("documents_with_error"),
        F.min("failure")["body"].alias("failure"),
        F.first("_gap")["body"].alias("gap"),
        F.max(F.when(read, F.col("last")))["updated"].alias("watermark"),
    ).join(frequent_messages(kinds, keys).withColumnRenamed("messages", "skips"), keys, "left")


def sync_once(
    store: SyncStore, cfg: SyncConfig, spaces: DataFrame, read: Reader, now: datetime,
    chain: Iterable[Preprocessor] = (),
) -> RunReport | None:
    """Read, reshape and store all due spaces, then advance state and activity log.

    ``spaces``: source, space_key of the source. Returns None when nothing is due.

    A document that cannot be stored fails its space: the run of that space is recorded
    as failed and its rows never become visible, the other spaces go on. An error of the
    whole pass, such as a reader that breaks, fails all of its spaces.
    """
    run_id = store.next_run()
    began = time.monotonic()
    state = store.state(cfg.source)
    due = st.planned_runs(spaces, state, now, cfg.update_period, cfg.full_update_period)
    if not cfg.read_mode.incremental:
        due = due.withColumn("full", F.lit(True))
    kinds = store.save(with_effective_kind(due), "plans", run_id)
    total, full = kinds.agg(F.count("*"), F.count_if("full")).first()
    if not total:
        return None
    before_runs = store.runs()
    failure = None
    try:
        docs = preprocess(read(kinds), chain)
        if path_type(docs.schema, "spaceKey") is None:
            raise DataShapeError("the reader must provide spaceKey, page_no and pos")
        rows = target_rows(docs, cfg, now, run_id, strict=False)
        rows.hint("rebalance", "source", "space_key").write.mode("append").partitionBy(*ROWS_PARTITIONS).parquet(
            store.path("rows")
        )
        counted = _counters(store, cfg, before_runs, kinds, run_id, some_full=full > 0, some_partial=full < total)
        runs = store.save(_run_rows(counted, now, began), "reports", run_id)
    except Exception as error:  # noqa: BLE001 - any failure becomes the result of the run
        lines = str(error).strip().splitlines()
        failure = lines[0] if lines else type(error).__name__
        failed = kinds.select(
            "source", "space_key", "full", *[F.lit(0).cast("bigint").alias(c) for c in COUNTERS],
            F.lit(False).alias("ok"), F.lit(failure).alias("error_message"), F.lit(None).cast("timestamp").alias("watermark"),
        )
        runs = store.save(_run_rows(failed, now, began), "reports", run_id)
    # First the data, then how far it goes: a pass that dies in between reads it once more.
    if failure is None:
        store.commit(runs.filter("ok"), run_id)
    store.write_state(_state_changes(runs, cfg, now), cfg.source, run_id)
    sinks.append_activity(act.activity_row(runs), store.path("activity"))
    return RunReport(run_id, runs)


def store_batch(store: SyncStore, cfg: SyncConfig, docs: DataFrame, now: datetime, stream: str, batch_id: int) -> None:
    """Store a batch of a stream as an incremental run, once however often it is tried.

    The run has its number from the store, as passes have. A document that cannot be stored
    is counted as an error and left out: a stream does not read it again. The update time
    of the spaces only advances.
    """
    if store.has_batch(stream, batch_id):
        return
    run_id, began, keys = store.next_run(), time.monotonic(), ["source", "space_key"]
    before_runs, state = store.runs(), store.state(cfg.source)
    rows = target_rows(docs, cfg, now, run_id, strict=False)
    rows = rows.withColumn("op", F.when(F.col("op") == "error", "skipped").otherwise(F.col("op")))
    rows.hint("rebalance", *keys).write.mode("append").partitionBy(*ROWS_PARTITIONS).parquet(store.path("rows"))
    spaces = store.rows().filter(F.col("run_id") == run_id).select(*keys).distinct()
    marks = state.filter(F.col("property") == st.WATERMARK).select(*keys, F.col("value").alias("updated_after"))
    kinds = spaces.join(marks, keys, "left").withColumn("full", F.lit(False))
    kinds = store.save(kinds, "plans", run_id)
    counted = _counters(store, cfg, before_runs, kinds, run_id, some_full=False, some_partial=True)
    counted = counted.join(kinds.select(*keys, "updated_after"), keys).withColumn("watermark", F.greatest("watermark", "updated_after"))
    runs = store.save(_run_rows(counted.drop("updated_after"), now, began), "reports", run_id)
    store.commit(runs, run_id, stream, batch_id)
    store.write_state(_state_changes(runs, cfg, now), cfg.source, run_id)
    sinks.append_activity(act.activity_row(runs), store.path("activity"))


def _run_rows(counted: DataFrame, now: datetime, began: float) -> DataFrame:
    return counted.select(
        "*",
        F.lit(now).alias("start_date"),
        F.lit(int((time.monotonic() - began) * 1000)).cast("bigint").alias("time_elapsed"),
    )


def _state_changes(runs: DataFrame, cfg: SyncConfig, now: datetime) -> DataFrame:
    keys = ["source", "space_key"]
    changes = runs.select(*keys, F.lit(st.LAST_START).alias("property"), F.lit(now).alias("value")).unionByName(
        st.finish(runs, now, cfg.full_update_period)
    )
    if cfg.read_mode.incremental:
        marks = runs.filter("watermark IS NOT NULL")
        changes = changes.unionByName(marks.select(*keys, F.lit(st.WATERMARK).alias("property"), F.col("watermark").alias("value")))
    return changes


def sync_source(
    store: SyncStore, cfg: SyncConfig, listed: DataFrame, read: Reader, now: datetime, chain: Iterable[Preprocessor] = ()
) -> RunReport | None:
    """A pass over the spaces that the configuration selects from the ``listed`` ones (space_key)."""
    chosen = select_spaces(listed, cfg.spaces_indexed, cfg.spaces_excluded).distinct()
    return sync_once(store, cfg, chosen.select(F.lit(cfg.source).alias("source"), "space_key"), read, now, chain)


def utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)
