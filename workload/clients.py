"""Whole passes over a remote system that is read page by page, and over a compacted store."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta
from itertools import islice

from pyspark.sql import functions as F, types as T

from syncspark.config import SyncConfig
from syncspark.operators.state import WATERMARK
from syncspark.plans.sync import sync_once, sync_source
from syncspark.session import prepare, shared_folder
from syncspark.sources.client import Page
from syncspark.sources.paged import page_source, source_reader
from workload.base import at, millis, query, table
from workload.changes import shown
from workload.passes import PASSES, new_store, two_passes

EVENT = T.StructType().add("id", "string").add("updated", "string").add("kind", "string").add("value", "double")
SPACES = [f"S{k}" for k in range(5)]
PAGE = 500


def remote_events(spark, d) -> str:
    """Folder of a remote system that has the events of a table by space, oldest first; a space is a fifth of the users."""
    folder, order = f"{shared_folder(prepare(spark))}/remote-{uuid.uuid4().hex}", ["space_key", F.asc_nulls_last("ts"), F.asc_nulls_last("event_id")]
    events = table(spark, d, "events").select(
        F.concat(F.lit("S"), F.pmod("user_id", F.lit(5)).cast("string")).alias("space_key"), F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "event_type", "value"
    )
    # In files that follow each other, of row groups that a request passes over or reads one by one.
    events.repartitionByRange(*order).sortWithinPartitions(*order).write.option("parquet.block.size", 4 << 20).parquet(folder)
    return folder


class EventClient:
    """The remote system of ``remote_events``. It answers from an open scan, and so holds a few pages, however large a space is."""

    def __init__(self, folder: str, broken: tuple[datetime, datetime] | None = None):
        self.folder, self.broken, self.open = folder, broken, None

    def page(self, space_key: str, start_at: int, full: bool, updated_after: datetime | None, updated_before: datetime | None) -> Page:
        if self.broken and updated_after and updated_before and self.broken[0] <= updated_after < self.broken[1]:
            raise ConnectionError("no answer")
        asked = (space_key, updated_after, updated_before)
        if self.open is None or self.open[:2] != (asked, start_at):
            total, rows = self._scan(*asked)
            self.open = asked, start_at, total, islice(rows, start_at, None)
        total, rows = self.open[2:]
        page = list(islice(rows, PAGE))
        self.open = asked, start_at + len(page), total, rows
        return Page(json.dumps(page), len(page), total)

    def _scan(self, space_key: str, after: datetime | None, before: datetime | None) -> tuple[int, Iterator[dict]]:
        """How many events a request has, and the events in order."""
        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        from pyarrow import fs

        where = pc.field("space_key") == space_key
        if after:
            where &= pc.field("ts") >= after.replace(tzinfo=None)
        if before:
            where &= pc.field("ts") <= before.replace(tzinfo=None)
        system, root = fs.FileSystem.from_uri(self.folder)
        files = sorted(f.path for f in system.get_file_info(fs.FileSelector(root)) if f.path.endswith(".parquet"))
        held = ds.dataset(files, filesystem=system, format="parquet")
        total = held.count_rows(filter=where)
        found = held.scanner(
            columns=["event_id", "ts", "event_type", "value"], filter=where, batch_size=10 * PAGE, batch_readahead=1, fragment_readahead=1, use_threads=False,
            fragment_scan_options=ds.ParquetFragmentScanOptions(pre_buffer=False),
        )
        rows = (
            {"id": str(r["event_id"]), "updated": r["ts"] and r["ts"].isoformat() + "+00:00", "kind": r["event_type"], "value": r["value"]}
            for batch in found.to_batches() for r in batch.to_pylist()
        )
        return total, rows


def _config(mode: str, **more) -> SyncConfig:
    return SyncConfig(
        source="remote", document_id="id", updated="updated", fields={"kind": "kind", "value": "value"}, read_mode=mode, full_update_period=timedelta(0), **more
    )


def _pass(spark, d, mode: str, name: str):
    prepare(spark).dataSource.register(page_source(EventClient(remote_events(spark, d)), name))
    store, cfg, now = new_store(spark), _config(mode, spaces_excluded="S3, S9"), at(2024, 2, 1)
    listed = spark.createDataFrame([(s,) for s in SPACES], "space_key string")
    sync_source(store, cfg, listed, source_reader(spark, cfg, name, EVENT, now=now), now)
    return shown(store.current())


STORED = """
SELECT 'document' AS doc_type, CAST(event_id AS VARCHAR) AS doc_id, 'S' || (user_id % 5) AS space_key, CAST(event_id AS VARCHAR) AS document_id,
       event_type AS kind, value, epoch_ms(TIMESTAMP '2024-02-01') AS indexed_ms FROM events WHERE user_id % 5 <> 3
"""


@query(f"WITH s AS ({STORED}), n AS (SELECT *, row_number() OVER (PARTITION BY space_key ORDER BY ts, event_id) AS i FROM s JOIN events ON event_id = CAST(doc_id AS BIGINT)) "
       f"SELECT doc_type, doc_id, space_key, document_id, kind, n.value, indexed_ms FROM n WHERE i <= {PAGE}")
def s6_simple_pass(spark, d):
    """One request a space; the remote system answers with its first page."""
    return _pass(spark, d, "simple", "events_simple")


@query(STORED)
def s7_paged_pass(spark, d):
    """Page after page, all but an excluded space."""
    return _pass(spark, d, "pagination", "events_paged")


@query("""
WITH e AS (SELECT *, 'S' || (user_id % 5) AS space_key FROM events),
w AS (SELECT space_key, max(ts) AS wm FROM e WHERE ts <= TIMESTAMP '2024-01-15' GROUP BY space_key),
k AS (SELECT space_key, wm, unnest(range(CAST(ceil(epoch_us(TIMESTAMP '2024-02-01' - wm) / (4 * 86400e6)) AS BIGINT))) AS k FROM w),
s AS (SELECT space_key, k, wm + INTERVAL 4 DAY * k AS a, least(wm + INTERVAL 4 DAY * (k + 1), TIMESTAMP '2024-02-01') AS b FROM k),
r AS (SELECT s.space_key, k, ts, a >= TIMESTAMP '2024-01-18' AND a < TIMESTAMP '2024-01-22' AS broken FROM s JOIN e ON e.space_key = s.space_key AND ts BETWEEN a AND b),
g AS (SELECT space_key, min(k) AS gap FROM s WHERE a >= TIMESTAMP '2024-01-18' AND a < TIMESTAMP '2024-01-22' GROUP BY space_key)
SELECT r.space_key, count(*) FILTER (NOT broken) AS documents_updated, 'ConnectionError: no answer' AS error_message, epoch_us(max(ts) FILTER (k < gap)) // 1000 AS watermark_ms
FROM r JOIN g ON g.space_key = r.space_key GROUP BY r.space_key
""")
def s9_sliced_pass(spark, d):
    """A second pass in slices of four days, of which one fails: what comes after it is stored,
    but the update time stays before it."""
    spark = prepare(spark)
    events = remote_events(spark, d)
    spark.dataSource.register(page_source(EventClient(events), "events_sliced"))
    spark.dataSource.register(page_source(EventClient(events, (at(2024, 1, 18), at(2024, 1, 22))), "events_broken"))
    store, cfg = new_store(spark), _config("updateTimestamp", slice_span=timedelta(days=4), first_update=at(2023, 12, 1))
    spaces = spark.createDataFrame([("remote", s) for s in SPACES], "source string, space_key string")
    first, second = at(2024, 1, 15), at(2024, 2, 1)
    sync_once(store, cfg, spaces, source_reader(spark, cfg, "events_sliced", EVENT, now=first), first)
    runs = sync_once(store, cfg, spaces, source_reader(spark, cfg, "events_broken", EVENT, now=second), second).runs
    marks = store.state("remote").filter(F.col("property") == WATERMARK).select("space_key", millis(F.col("value")).alias("watermark_ms"))
    return runs.join(marks, "space_key").select("space_key", "documents_updated", "error_message", "watermark_ms")


@query(f"""
WITH {PASSES}
SELECT 'document' AS doc_type, id AS doc_id, space_key, id AS document_id, kind, value,
       epoch_ms(CASE WHEN second THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-15' END) AS indexed_ms
FROM a WHERE up IS NOT NULL AND (dn IS NULL OR up > dn)
""")
def u3_compacted_store(spark, d):
    """The same rows once the runs of every space are folded into one."""
    store = two_passes(spark, d)
    store.compact(fan=2)
    return shown(store.current())
