"""U1-U14: applying changes. The events are the feed, a user has ten documents."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from syncspark.config import SyncConfig
from syncspark.operators import changes as ch
from workload.base import at, millis, query, table, text

CUT = at(2024, 1, 15)
RUN_START = at(2024, 2, 1)
CUT_SQL = "TIMESTAMP '2024-01-15'"
ORDER = ["page_no", "pos"]
CONFIG = SyncConfig(
    source="feed",
    document_id="id",
    updated="updated",
    deleted="kind",
    deleted_value="error",
    fields={"kind": "kind", "value": "value"},
)


def feed(spark, d) -> DataFrame:
    """Changed documents: 100 to a page, in order of the event."""
    return table(spark, d, "events").select(
        F.concat_ws("-", "user_id", F.col("event_id") % 10).alias("id"),
        "user_id",
        F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("spaceKey"),
        F.col("ts").alias("updated"),
        F.col("event_type").alias("kind"),
        "value",
        F.floor(F.col("event_id") / 100).cast("bigint").alias("page_no"),
        (F.col("event_id") % 100).alias("pos"),
        "event_id",
    )


def split(df: DataFrame):
    """Documents before the cut, and those from it on."""
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    return df.filter(F.col("updated") < cut), df.filter(F.col("updated") >= cut)


def target(spark, d) -> DataFrame:
    """Index as of the cut: the newest version of every document, deleted ones included."""
    before, _ = split(feed(spark, d))
    rows = ch.split_changes(before.withColumn("kind", F.upper("kind")), CONFIG, ORDER).upserts
    newest = ch.latest(rows, ch.ROW_KEY, ORDER)
    return newest.drop(*ORDER).withColumn("indexed_at", F.lit(CUT))


# Newest version per document on either side of the cut, as DuckDB sees it.
SIDES = f"""
e AS (SELECT *, user_id || '-' || (event_id % 10) AS id, 'S' || (user_id % 5) AS space_key FROM events),
old AS (SELECT id, space_key, upper(arg_max(event_type, event_id)) AS kind, arg_max(value, event_id) AS value
        FROM e WHERE ts < {CUT_SQL} GROUP BY ALL),
new AS (SELECT id, space_key, arg_max(event_type, event_id) FILTER (event_type <> 'error') AS kind,
               arg_max(value, event_id) FILTER (event_type <> 'error') AS value,
               max(event_id) FILTER (event_type <> 'error') AS up, max(event_id) FILTER (event_type = 'error') AS del
        FROM e WHERE ts >= {CUT_SQL} GROUP BY ALL)
"""


def shown(rows: DataFrame) -> DataFrame:
    """Comparable columns of target rows."""
    return rows.select(
        "doc_type", "doc_id", "space_key", "document_id",
        F.get_json_object("body", "$.kind").alias("kind"),
        F.get_json_object("body", "$.value").cast("double").alias("value"),
        millis(F.col("indexed_at")).alias("indexed_ms"),
    )


@query(f"""
WITH {SIDES}
SELECT 'document' AS doc_type, id AS doc_id, space_key, id AS document_id, kind, value, epoch_ms({CUT_SQL}) AS indexed_ms
FROM old WHERE id NOT IN (SELECT id FROM new WHERE up IS NOT NULL)
UNION ALL
SELECT 'document', id, space_key, id, kind, value, epoch_ms(TIMESTAMP '2024-02-01') FROM new WHERE up IS NOT NULL
""")
def u1_upsert(spark, d):
    _, after = split(feed(spark, d))
    rows = ch.split_changes(after, CONFIG, ORDER).upserts.withColumn("indexed_at", F.lit(RUN_START))
    return shown(ch.upsert(target(spark, d), rows, ch.ROW_KEY, ORDER))


@query(f"""
WITH {SIDES}
SELECT id AS doc_id, space_key, kind FROM old WHERE id NOT IN (SELECT id FROM new WHERE del IS NOT NULL)
""")
def u2_flagged_delete(spark, d):
    _, after = split(feed(spark, d))
    deletes = ch.split_changes(after, CONFIG, ORDER).deletes
    kept = ch.flagged_delete(target(spark, d), deletes, CONFIG.doc_types)
    return shown(kept).select("doc_id", "space_key", "kind")


@query(f"""
WITH {SIDES}
SELECT id AS doc_id, space_key, kind FROM new WHERE up IS NOT NULL AND space_key IN ('S0', 'S1')
UNION ALL
SELECT o.id, o.space_key, coalesce(n.kind, o.kind) FROM old o LEFT JOIN new n ON n.id = o.id AND n.up IS NOT NULL
WHERE o.space_key NOT IN ('S0', 'S1')
UNION ALL
SELECT id, space_key, kind FROM new n WHERE up IS NOT NULL AND space_key NOT IN ('S0', 'S1') AND id NOT IN (SELECT id FROM old)
""")
def u3_stale_delete(spark, d):
    _, after = split(feed(spark, d))
    rows = ch.split_changes(after, CONFIG, ORDER).upserts.withColumn("indexed_at", F.lit(RUN_START))
    refreshed = ch.upsert(target(spark, d), rows, ch.ROW_KEY, ORDER)
    kept = ch.stale_delete(refreshed, "feed", ["S0", "S1"], RUN_START, CONFIG.doc_types)
    return shown(kept).select("doc_id", "space_key", "kind")


def with_comments(spark, d) -> DataFrame:
    """Target of orders before 1998 with their lines as comments; a line may repeat."""
    orders = table(spark, d, "orders").select(text("o_orderkey").alias("document_id"), F.col("o_orderpriority").alias("space_key"))
    parents = orders.select(
        F.lit("document").alias("doc_type"), F.col("document_id").alias("doc_id"), F.lit(None).cast("string").alias("parent_id"),
        F.lit("shop").alias("source"), "space_key", "document_id",
    )
    lines = table(spark, d, "lineitem").select(text("l_orderkey").alias("document_id"), "l_linenumber", "l_partkey", "l_suppkey")
    children = lines.join(orders, "document_id").select(
        F.lit("comment").alias("doc_type"),
        F.concat_ws("-", "document_id", "l_linenumber", "l_partkey", "l_suppkey").alias("doc_id"),
        F.col("document_id").alias("parent_id"), F.lit("shop").alias("source"), "space_key", "document_id",
    )
    return parents.unionByName(children)


def closed_orders(spark, d) -> DataFrame:
    """Deletes: finished orders, scoped to source and space."""
    return table(spark, d, "orders").filter("o_orderstatus = 'F'").select(
        F.lit("shop").alias("source"), F.col("o_orderpriority").alias("space_key"), text("o_orderkey").alias("document_id")
    )


@query("""
SELECT 'all_types' AS scope, count(*) AS removed FROM (
  SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT l_orderkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F')
UNION ALL SELECT 'documents_only', count(*) FROM orders WHERE o_orderstatus = 'F'
""")
def u4_delete_scope(spark, d):
    rows, gone = with_comments(spark, d), closed_orders(spark, d)
    scopes = {"all_types": ["document", "comment"], "documents_only": ["document"]}
    counts = [
        ch.removed_by(rows, gone, types).agg(F.count("*").alias("removed")).select(F.lit(name).alias("scope"), "removed")
        for name, types in scopes.items()
    ]
    return counts[0].unionByName(counts[1])


@query("""
SELECT 'shop' AS source, o_orderpriority AS space_key, count(DISTINCT o_orderkey) AS documents_deleted,
       count(l_orderkey) AS comments_deleted
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY o_orderpriority
""")
def u5_delete_counters(spark, d):
    removed = ch.removed_by(with_comments(spark, d), closed_orders(spark, d), ["document", "comment"])
    return ch.delete_counters(removed, "document")


INCREMENTAL_SQL = f"""
WITH {SIDES}
SELECT 'document' AS doc_type, id AS doc_id, space_key, id AS document_id, kind, value, epoch_ms({CUT_SQL}) AS indexed_ms
FROM old WHERE id NOT IN (SELECT id FROM new)
UNION ALL
SELECT 'document', id, space_key, id, kind, value, epoch_ms(TIMESTAMP '2024-02-01') FROM new
WHERE up IS NOT NULL AND (del IS NULL OR up > del)
"""


@query(INCREMENTAL_SQL)
def u6_incremental_run(spark, d):
    _, after = split(feed(spark, d))
    changes = ch.split_changes(after, CONFIG, ORDER)
    return shown(ch.apply_changes(target(spark, d), changes, ORDER, RUN_START, CONFIG.doc_types))


@query(f"""
SELECT 'feed' AS source, 'S' || (user_id % 5) AS space_key,
       user_id % 5 = 4 OR count(*) FILTER (ts < {CUT_SQL} AND user_id % 5 <> 3) = 0 AS full,
       CASE WHEN user_id % 5 < 3 THEN epoch_us(max(ts) FILTER (ts < {CUT_SQL})) // 1000 END AS after_ms
FROM events GROUP BY user_id % 5
""")
def u7_full_promotion(spark, d):
    docs = feed(spark, d)
    spaces = docs.select(F.lit("feed").alias("source"), F.col("spaceKey").alias("space_key")).distinct()
    spaces = spaces.withColumn("full", F.col("space_key") == "S4")
    before, _ = split(docs.filter("spaceKey <> 'S3'"))
    marks = before.groupBy(F.lit("feed").alias("source"), F.col("spaceKey").alias("space_key")).agg(
        F.max(F.col("updated").cast("timestamp")).alias("watermark")
    )
    return ch.effective_kind(spaces, marks).select("source", "space_key", "full", millis(F.col("updated_after")).alias("after_ms"))


def read_log(spark, d) -> DataFrame:
    """What a run saw: purchases could not be reached, deletes of user 0 found nothing."""
    return feed(spark, d).select(
        F.lit("feed").alias("source"), F.col("spaceKey").alias("space_key"), "page_no", "pos",
        F.col("updated").cast("timestamp").alias("updated"),
        (F.col("kind") != "purchase").alias("reachable"),
        ((F.col("kind") != "error") | (F.col("user_id") != 0)).alias("wrote"),
        (F.col("kind") == "error").alias("deleted"),
        (F.col("value") > 90).alias("rejected"),
        "event_id", "id",
    )


@query("""
WITH p AS (
  SELECT user_id % 5 AS s, event_id // 100 AS page_no,
         arg_max(ts, event_id) FILTER (event_type <> 'purchase') AS last_ts,
         bool_or(event_type <> 'purchase' AND (event_type <> 'error' OR user_id <> 0)) AS wrote
  FROM events GROUP BY ALL)
SELECT 'feed' AS source, 'S' || s AS space_key, epoch_us(arg_max(last_ts, page_no) FILTER (wrote)) // 1000 AS watermark_ms
FROM p GROUP BY s HAVING bool_or(wrote)
""")
def u8_watermark_advance(spark, d):
    return ch.watermark_advance(read_log(spark, d)).select("source", "space_key", millis(F.col("watermark")).alias("watermark_ms"))


@query("""
SELECT user_id, epoch_us(max(ts)) // 1000 + CASE WHEN user_id % 2 = 0 AND count(*) FILTER (event_type <> 'error') > 0 THEN 1000 ELSE 0 END AS stored_ms
FROM events GROUP BY user_id
""")
def u9_watermark_bump(spark, d):
    runs = feed(spark, d).groupBy("user_id").agg(
        F.max(F.col("updated").cast("timestamp")).alias("stop"), F.count_if(F.col("kind") != "error").alias("updated")
    )
    start = F.when(F.col("user_id") % 2 == 0, F.col("stop")).otherwise(F.col("stop") - F.lit(timedelta(minutes=1)))
    return runs.select("user_id", millis(ch.watermark_bump(start, F.col("stop"), F.col("updated"))).alias("stored_ms"))


@query("SELECT event_id, epoch_us(ts) // 1000 AS updated_ms FROM events")
def u11_required_update_time(spark, d):
    docs = feed(spark, d)
    updated = ch.require_updated(ch.document_updated(docs.schema, "updated"), F.col("id"))
    return docs.select("event_id", millis(updated).alias("updated_ms"))


@query("""
SELECT 'feed' AS source, 'S' || (user_id % 5) AS space_key,
       count(*) FILTER (event_type NOT IN ('purchase', 'error') AND value <= 90) AS documents_updated,
       count(*) FILTER (event_type = 'purchase' OR (event_type <> 'error' AND value > 90)) AS documents_with_error,
       count(*) FILTER (event_type = 'error') AS documents_flagged
FROM events GROUP BY user_id % 5
""")
def u12_run_counters(spark, d):
    return ch.run_counters(read_log(spark, d))


@query("""
WITH k AS (SELECT user_id % 5 AS s, event_type AS message, count(*) AS n FROM events WHERE user_id % 5 <> 1 GROUP BY ALL),
m AS (SELECT s, string_agg(message, chr(10) ORDER BY message) AS messages, sum(n) AS n FROM k GROUP BY s),
r AS (SELECT user_id % 5 AS s, epoch_us(min(ts)) // 1000 AS a, epoch_us(max(ts)) // 1000 AS b FROM events GROUP BY ALL)
SELECT 'feed' AS source, 'S' || r.s AS space_key, CASE WHEN r.s = 2 THEN 'ERROR' ELSE 'OK' END AS result, b - a AS time_elapsed,
       CAST(coalesce(n, 0) AS BIGINT) AS documents_with_error,
       CASE WHEN r.s = 2 THEN messages || chr(10) || 'broken off' ELSE messages END AS error_message
FROM r LEFT JOIN m ON m.s = r.s
""")
def u13_run_outcome(spark, d):
    docs = feed(spark, d).select(F.lit("feed").alias("source"), F.col("spaceKey").alias("space_key"), "updated", "kind")
    runs = docs.groupBy("source", "space_key").agg(
        F.min("updated").alias("start_date"), F.max("updated").alias("end_date")
    ).withColumn("failure", F.when(F.col("space_key") == "S2", " broken off "))
    errors = docs.filter("space_key <> 'S1'").select("source", "space_key", F.col("kind").alias("message"))
    return ch.run_outcome(runs, errors)


@query(f"""
WITH e AS (SELECT *, CAST(user_id AS VARCHAR) || '/' || event_type AS id FROM events),
a AS (SELECT id, arg_max(value, event_id) AS v FROM e WHERE ts < TIMESTAMP '2024-01-05' GROUP BY id),
b AS (SELECT id, arg_max(value, event_id) AS v FROM e WHERE ts >= TIMESTAMP '2024-01-03' GROUP BY id)
SELECT coalesce(a.id, b.id) AS id,
       CASE WHEN a.id IS NULL THEN 'added' WHEN b.id IS NULL THEN 'removed' WHEN a.v = b.v THEN 'unchanged' ELSE 'changed' END AS status
FROM a FULL JOIN b ON a.id = b.id
""")
def u14_snapshot_diff(spark, d):
    docs = feed(spark, d).select(F.concat_ws("/", "user_id", "kind").alias("id"), "value", "updated", "event_id")
    day = lambda text: F.lit(text).cast("timestamp_ntz")
    before = ch.latest(docs.filter(F.col("updated") < day("2024-01-05")).drop("updated"), ["id"], ["event_id"])
    after = ch.latest(docs.filter(F.col("updated") >= day("2024-01-03")).drop("updated"), ["id"], ["event_id"])
    return ch.snapshot_diff(before, after, ["id"], ["value"])
