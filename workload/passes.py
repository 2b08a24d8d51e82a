"""Whole passes over a stored target, and W1-W4: the same over a stream."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from syncspark.config import SyncConfig
from syncspark.operators.state import WATERMARK
from syncspark.plans.store import SyncStore
from syncspark.plans.sync import sync_once
from syncspark.session import prepare, shared_folder
from syncspark.sources.reads import scan_updated_per_space
from syncspark.streaming import sync as stream
from workload.base import millis, query, table
from workload.changes import CONFIG, CUT, RUN_START, feed, shown

PASS_CONFIG = SyncConfig(
    source="feed", document_id="id", updated="updated", deleted="kind", deleted_value="error",
    fields={"kind": "kind", "value": "value"}, full_update_period=timedelta(0),
)


def new_store(spark) -> SyncStore:
    return SyncStore(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")


def two_passes(spark, d) -> SyncStore:
    """A first pass, full as nothing is stored, and an incremental one from its watermarks."""
    docs = feed(spark, d).withColumn("updated", F.col("updated").cast("timestamp"))
    spaces = docs.select(F.lit("feed").alias("source"), F.col("spaceKey").alias("space_key")).distinct()
    store = new_store(spark)
    early = docs.filter(F.col("updated") < F.lit(CUT))

    def read(source: DataFrame):
        def reader(kinds: DataFrame) -> DataFrame:
            found = scan_updated_per_space(source.withColumn("space_key", F.col("spaceKey")), "updated", kinds)
            return found.drop("space_key")

        return reader

    sync_once(store, PASS_CONFIG, spaces, read(early), CUT)
    sync_once(store, PASS_CONFIG, spaces, read(docs), RUN_START)
    return store


PASSES = """
e AS (SELECT *, user_id || '-' || (event_id % 10) AS id, 'S' || (user_id % 5) AS space_key, event_type = 'error' AS del FROM events),
w AS (SELECT space_key, max(ts) AS wm FROM e WHERE ts < TIMESTAMP '2024-01-15' GROUP BY space_key),
v AS (SELECT e.*, ts >= wm AS second FROM e JOIN w ON w.space_key = e.space_key),
a AS (SELECT id, space_key, max(event_id) FILTER (NOT del) AS up, max(event_id) FILTER (del) AS dn,
             arg_max(event_type, event_id) FILTER (NOT del) AS kind, arg_max(value, event_id) FILTER (NOT del) AS value,
             arg_max(second, event_id) FILTER (NOT del) AS second FROM v GROUP BY ALL)
"""


@query(f"""
WITH {PASSES}
SELECT 'document' AS doc_type, id AS doc_id, space_key, id AS document_id, kind, value,
       epoch_ms(CASE WHEN second THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-15' END) AS indexed_ms
FROM a WHERE up IS NOT NULL AND (dn IS NULL OR up > dn)
""")
def u6_sync_passes(spark, d):
    return shown(two_passes(spark, d).current())


@query(f"""
WITH {PASSES},
first AS (SELECT id, space_key, max(event_id) FILTER (NOT del) AS up, max(event_id) FILTER (del) AS dn FROM e
          WHERE ts < TIMESTAMP '2024-01-15' GROUP BY ALL),
gone AS (SELECT space_key, count(*) AS n FROM first WHERE up IS NOT NULL AND (dn IS NULL OR up > dn)
         AND id IN (SELECT id FROM v WHERE second AND del) GROUP BY space_key)
SELECT 'FULL' AS update_type, space_key, count(*) FILTER (NOT del) AS documents_updated, 0 AS documents_deleted, 0 AS comments_deleted, 'OK' AS result
FROM v WHERE ts < TIMESTAMP '2024-01-15' GROUP BY space_key
UNION ALL
SELECT 'INCREMENTAL', v.space_key, count(*) FILTER (NOT del AND second), coalesce(any_value(n), 0), 0, 'OK'
FROM v LEFT JOIN gone ON gone.space_key = v.space_key GROUP BY v.space_key
""")
def u12_sync_records(spark, d):
    records = two_passes(spark, d).activity()
    counts = [F.col(c).cast("bigint").alias(c) for c in ("documents_updated", "documents_deleted", "comments_deleted")]
    return records.select("update_type", "space_key", *counts, "result")


# --- streams --------------------------------------------------------------------


def event_stream(spark, d) -> DataFrame:
    schema = table(spark, d, "events").schema
    # As a pattern the path may name one file as well as a folder of many. All of them
    # are one batch, as their order is not the order of the events.
    return prepare(spark).readStream.schema(schema).parquet(f"{d}/event[s].parquet")


def feed_stream(spark, d) -> DataFrame:
    return event_stream(spark, d).select(
        F.concat_ws("-", "user_id", F.col("event_id") % 10).alias("id"),
        F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("spaceKey"),
        F.col("ts").cast("timestamp").alias("updated"),
        F.col("event_type").alias("kind"),
        "value",
        F.floor(F.col("event_id") / 100).cast("bigint").alias("page_no"),
        (F.col("event_id") % 100).alias("pos"),
        "event_id",
    )


def finished(running) -> None:
    running.awaitTermination()
    if running.exception() is not None:
        raise running.exception()


LIVE = """
WITH a AS (SELECT user_id || '-' || (event_id % 10) AS id, 'S' || (user_id % 5) AS space_key, max(event_id) FILTER (event_type <> 'error') AS up,
                  max(event_id) FILTER (event_type = 'error') AS dn, arg_max(event_type, event_id) AS kind, arg_max(value, event_id) AS value
           FROM events GROUP BY ALL)
"""


@query(LIVE + """
SELECT 'document' AS doc_type, id AS doc_id, space_key, id AS document_id, kind, value, epoch_ms(TIMESTAMP '2024-02-01') AS indexed_ms
FROM a WHERE up > coalesce(dn, -1)
""")
def w1_continuous_sync(spark, d):
    store = new_store(spark)
    finished(stream.continuous_sync(feed_stream(spark, d), store, CONFIG, store.path("checkpoint"), clock=lambda: RUN_START))
    return shown(store.current())


@query(LIVE + "SELECT id, kind, value FROM a WHERE up > coalesce(dn, -1)")
def w2_latest_by_key(spark, d):
    store = new_store(spark)
    docs = feed_stream(spark, d).withColumn("gone", F.col("kind") == "error")
    latest = stream.latest_by_key(docs, ["id"], ["event_id"], "gone", ["kind", "value"])
    finished(stream.write_latest(latest, store.path("latest"), store.path("checkpoint")))
    return stream.read_latest(spark.read.parquet(store.path("latest")), ["id"])


@query("SELECT user_id || '-' || (event_id % 10) AS id, epoch_us(ts) // 1000 AS updated_ms, any_value(event_type) AS kind FROM events GROUP BY user_id, event_id % 10, ts")
def w3_absorb_rereads(spark, d):
    store = new_store(spark)
    twice = feed_stream(spark, d).unionByName(feed_stream(spark, d))
    once = stream.absorb_rereads(twice, ["id"], "updated").select("id", "updated", "kind")
    finished(
        once.writeStream.outputMode("append").option("checkpointLocation", store.path("checkpoint"))
        .trigger(availableNow=True).format("parquet").start(store.path("once"))
    )
    return spark.read.schema(once.schema).parquet(store.path("once")).select("id", millis(F.col("updated")).alias("updated_ms"), "kind")


@query("""
SELECT 'INCREMENTAL' AS update_type, 'S' || (user_id % 5) AS space_key, count(*) FILTER (event_type <> 'error') AS documents_updated,
       CAST(0 AS BIGINT) AS documents_deleted, 'OK' AS result, epoch_us(max_by(ts, event_id)) // 1000 AS last_ms
FROM events GROUP BY user_id % 5
""")
def w4_batch_progress(spark, d):
    store = new_store(spark)
    finished(stream.continuous_sync(feed_stream(spark, d), store, CONFIG, store.path("checkpoint"), clock=lambda: RUN_START))
    marks = store.state("feed").filter(F.col("property") == WATERMARK).select("space_key", millis(F.col("value")).alias("last_ms"))
    counts = [F.col(c).cast("bigint").alias(c) for c in ("documents_updated", "documents_deleted")]
    return store.activity().join(marks, "space_key").select("update_type", "space_key", *counts, "result", "last_ms")
