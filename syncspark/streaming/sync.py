"""Continuous synchronisation with Structured Streaming.

The stream's checkpoint takes the place of a stored watermark and is what a restart
continues from. ``maxFilesPerTrigger`` on the source bounds a batch as a time span
bounds a request.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from syncspark.config import SyncConfig
from syncspark.plans.store import SyncStore
from syncspark.plans.sync import store_batch


def _start(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, period: str | None, mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    writer = writer.trigger(processingTime=period) if period else writer.trigger(availableNow=True)
    return writer.start()


def continuous_sync(
    docs: DataFrame, store: SyncStore, cfg: SyncConfig, checkpoint: str, period: str | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
) -> StreamingQuery:
    """Store every batch of a document stream as an incremental run.

    ``docs``: documents with spaceKey, page_no and pos. A batch is a run of the store like
    a pass, known by the stream and the batch's number: a batch that is repeated after a
    failure is not stored twice, and streams and passes may share a store. Run records
    and update times are kept as by a pass. Without ``period`` the stream handles what
    is there and stops.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        store_batch(store, cfg, batch, clock(), query, batch_id)

    return _start(docs, sink, checkpoint, period)


def latest_by_key(stream: DataFrame, keys: list[str], order: list[str], deleted: str, fields: list[str]) -> DataFrame:
    """Newest state per key with its tombstone flag, as a streaming aggregate.

    The state per key is one row in Spark's own state store, and every task reduces its
    part of a batch before the shuffle. A change older than the stored one is ignored.
    """
    newest = F.max_by(F.struct(*fields, F.col(deleted).alias("deleted")), F.struct(*order))
    return stream.groupBy(*keys).agg(newest.alias("_n"), F.max(F.struct(*order)).alias("_at")).select(
        *keys, "_n.*", *[F.col("_at")[c].alias(f"_{c}") for c in order]
    )


def write_latest(latest: DataFrame, path: str, checkpoint: str, period: str | None = None) -> StreamingQuery:
    """Append each batch's changed keys; ``read_latest`` resolves them."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return _start(latest, sink, checkpoint, period, mode="update")


def read_latest(changed: DataFrame, keys: list[str]) -> DataFrame:
    """Live rows out of what ``write_latest`` stored; tombstones are left out."""
    rest = [c for c in changed.columns if c not in keys and c != "batch_id"]
    newest = F.max_by(F.struct(*rest), F.col("batch_id"))
    resolved = changed.groupBy(*keys).agg(newest.alias("_n")).select(*keys, "_n.*")
    kept = [c for c in resolved.columns if not c.startswith("_") and c != "deleted"]
    return resolved.filter(~F.col("deleted")).select(*kept)


def absorb_rereads(stream: DataFrame, keys: list[str], updated: str, delay: str | None = None) -> DataFrame:
    """Drop a document version that an inclusive watermark delivers again.

    Every version is remembered, however late it comes; the state store should be one on
    disk. With ``delay`` the state is bounded: versions that much behind the newest update
    time are forgotten, and what comes later than that is left out.
    """
    if delay is None:
        return stream.dropDuplicates([*keys, updated])
    return stream.withWatermark(updated, delay).dropDuplicatesWithinWatermark([*keys, updated])
