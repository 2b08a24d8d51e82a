"""G1-G12 and S23: state, scheduling decisions, run records and reports."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from syncspark.operators import activity as act, sinks, state as st
from syncspark.session import shared_folder
from workload.base import at, millis, query, table, text

NOW = at(2024, 1, 31)
PERIOD = timedelta(hours=6)
FULL_PERIOD = timedelta(days=3)


def runs(spark, d) -> DataFrame:
    """Every event as a finished run: its user is the space, one source per ten users."""
    value = F.col("value")
    return table(spark, d, "events").select(
        F.concat(F.lit("src"), (F.col("user_id") % 10).cast("string")).alias("source"),
        F.concat(F.lit("U"), text("user_id")).alias("space_key"),
        (F.col("event_type") == "purchase").alias("full"),
        F.col("ts").cast("timestamp").alias("start_date"),
        F.floor(value).cast("bigint").alias("documents_updated"),
        (F.col("event_id") % 7).alias("documents_deleted"),
        (F.col("event_id") % 5).alias("comments_deleted"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).cast("bigint").alias("documents_with_error"),
        (F.col("event_type") != "error").alias("ok"),
        (F.col("event_id") % 1000).alias("time_elapsed"),
        F.when(F.col("event_type") == "error", F.concat(F.lit(" broken "), text("event_id"))).alias("error_message"),
    )


def state(spark, d) -> DataFrame:
    """State of the spaces: last start and last full run, and some flags."""
    ts = F.col("start_date")
    per_space = runs(spark, d).groupBy("source", "space_key").agg(
        F.max(ts).alias(st.LAST_START),
        F.max(F.when(F.col("full"), ts)).alias(st.LAST_FULL),
        F.max(F.when(~F.col("ok") & (F.col("documents_deleted") == 3), ts)).alias(st.FORCE_INCREMENTAL),
        F.max(F.when(~F.col("ok") & (F.col("documents_updated") > 98), ts)).alias(st.FORCE_FULL),
    )
    names = [st.LAST_START, st.LAST_FULL, st.FORCE_INCREMENTAL, st.FORCE_FULL]
    return per_space.select(
        "source", "space_key",
        F.explode(F.map_filter(F.create_map(*[x for n in names for x in (F.lit(n), F.col(n))]), lambda _, v: v.isNotNull())).alias("property", "value"),
    )


def spaces(spark, d) -> DataFrame:
    return runs(spark, d).select("source", "space_key").distinct()


RUNS_SQL = """
r AS (SELECT *, 'src' || (user_id % 10) AS source, 'U' || user_id AS space_key FROM events),
s AS (SELECT source, space_key, user_id, max(ts) AS last_start, max(ts) FILTER (event_type = 'purchase') AS last_full,
             max(ts) FILTER (event_type = 'error' AND event_id % 7 = 3) AS force_incremental,
             max(ts) FILTER (event_type = 'error' AND floor(value) > 98) AS force_full
      FROM r GROUP BY ALL),
st AS (SELECT source, space_key, 'last_start' AS property, last_start AS value FROM s
       UNION ALL SELECT source, space_key, 'last_full', last_full FROM s WHERE last_full IS NOT NULL
       UNION ALL SELECT source, space_key, 'force_incremental', force_incremental FROM s WHERE force_incremental IS NOT NULL
       UNION ALL SELECT source, space_key, 'force_full', force_full FROM s WHERE force_full IS NOT NULL)
"""
FULL_SQL = "(force_full IS NOT NULL OR last_full IS NULL OR last_full < TIMESTAMP '2024-01-31' - INTERVAL 3 DAY)"


def shown(rows: DataFrame) -> DataFrame:
    return rows.select(
        "source", "space_key", "property", millis(F.col("value")).alias("value_ms"),
        st.state_key(F.col("property"), F.col("space_key")).alias("key"),
    )


@query(f"""
WITH {RUNS_SQL}
SELECT source, space_key, property, epoch_us(value) // 1000 AS value_ms, '_' || property || '_' || space_key AS key FROM st
WHERE property NOT IN ('last_full', 'force_full')
UNION ALL
SELECT source, space_key, 'last_full', 1704067200000, '_last_full_' || space_key FROM s
""")
def g1_state_put(spark, d):
    kept = state(spark, d)
    every = spaces(spark, d)
    put = every.select("source", "space_key", F.lit(st.LAST_FULL).alias("property"), F.lit(at(2024, 1, 1)).alias("value"))
    older = put.withColumn("value", F.lit(at(2023, 1, 1)))
    drop = every.select("source", "space_key", F.lit(st.FORCE_FULL).alias("property"), F.lit(None).cast("timestamp").alias("value"))
    changes = older.withColumn("n", F.lit(1)).unionByName(put.withColumn("n", F.lit(2))).unionByName(drop.withColumn("n", F.lit(3)))
    return shown(st.state_put(kept, changes, "n"))


@query(f"""
WITH {RUNS_SQL}
SELECT source, space_key, force_full IS NOT NULL AS existed, TRUE AS gone FROM s
""")
def g1_state_delete(spark, d):
    asked = spaces(spark, d).withColumn("property", F.lit(st.FORCE_FULL))
    left, existed = st.state_delete(state(spark, d), asked)
    still = st.state_get(left, st.FORCE_FULL)
    return existed.join(still, ["source", "space_key"], "left").select(
        "source", "space_key", "existed", F.col(st.FORCE_FULL).isNull().alias("gone")
    )


@query(f"""
WITH {RUNS_SQL}
SELECT source, space_key, {FULL_SQL} AS "full" FROM s
WHERE force_full IS NOT NULL OR force_incremental IS NOT NULL OR last_start < TIMESTAMP '2024-01-31' - INTERVAL 6 HOUR OR {FULL_SQL}
UNION ALL
SELECT source, space_key || 'new', TRUE FROM s WHERE user_id % 3 = 0
""")
def g2_spaces_due(spark, d):
    known = spaces(spark, d)
    third = F.regexp_extract("space_key", "[0-9]+", 0).cast("bigint") % 3 == 0
    new = known.filter(third).withColumn("space_key", F.concat("space_key", F.lit("new")))
    return st.spaces_due(known.unionByName(new), state(spark, d), NOW, PERIOD, FULL_PERIOD)


@query(f"""
WITH {RUNS_SQL}
SELECT 'period' AS rule, source, space_key FROM s WHERE {FULL_SQL}
UNION ALL SELECT 'never', source, space_key FROM s WHERE force_full IS NOT NULL
UNION ALL SELECT 'calendar', source, space_key FROM s WHERE force_full IS NOT NULL OR user_id % 2 = 0
""")
def g3_spaces_due_full(spark, d):
    known, kept = spaces(spark, d), state(spark, d)
    even = F.regexp_extract("space_key", "[0-9]+", 0).cast("bigint") % 2 == 0
    calendar = known.withColumn("next_full_at", F.when(even, F.lit(at(2024, 1, 30))).otherwise(F.lit(at(2024, 2, 2))))
    out = {
        "period": st.spaces_due_full(known, kept, NOW, FULL_PERIOD),
        "never": st.spaces_due_full(known, kept, NOW, timedelta(0)),
        "calendar": st.spaces_due_full(calendar, kept, NOW, FULL_PERIOD),
    }
    named = [df.select(F.lit(rule).alias("rule"), "source", "space_key") for rule, df in out.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query(f"""
WITH {RUNS_SQL}
SELECT 'all' AS asked, source, space_key, 'force_full' AS property FROM s
UNION ALL SELECT 'one', source, space_key, 'force_incremental' FROM s WHERE space_key = 'U7'
""")
def g4_force(spark, d):
    known = spaces(spark, d)
    asked = {
        "all": st.force(known, st.FORCE_FULL, NOW),
        "one": st.force(known, st.FORCE_INCREMENTAL, NOW, "U7"),
        "unknown": st.force(known, st.FORCE_FULL, NOW, "nowhere"),
    }
    named = [df.select(F.lit(name).alias("asked"), "source", "space_key", "property") for name, df in asked.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query(f"""
WITH {RUNS_SQL},
l AS (SELECT source, space_key, arg_max(event_type, ts) AS t FROM r GROUP BY ALL)
SELECT source, space_key, 'force_incremental' AS property, CAST(NULL AS BIGINT) AS value_ms FROM l
UNION ALL SELECT source, space_key, 'force_full', NULL FROM l WHERE t <> 'error'
UNION ALL SELECT source, space_key, 'last_full', epoch_ms(TIMESTAMP '2024-01-31') FROM l WHERE t <> 'error'
UNION ALL SELECT source, space_key, 'force_full', epoch_ms(TIMESTAMP '2024-01-31') FROM l WHERE t = 'error'
""")
def g5_finish(spark, d):
    last = act.last_run(runs(spark, d)).withColumn("full", F.lit(True))
    return st.finish(last, NOW, timedelta(0)).select("source", "space_key", "property", millis(F.col("value")).alias("value_ms"))


RECORD_SQL = """
SELECT source, space_key, CASE WHEN event_type = 'purchase' THEN 'FULL' ELSE 'INCREMENTAL' END AS update_type,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(epoch_us(ts) // 1000 % 1000 AS VARCHAR), 3, '0') || 'Z' AS start_date,
       CAST(floor(value) AS INTEGER) AS documents_updated, CAST(event_id % 7 AS INTEGER) AS documents_deleted,
       CAST(event_id % 5 AS INTEGER) AS comments_deleted, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS documents_with_error,
       CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'OK' END AS result, (event_id % 1000) || 'ms' AS time_elapsed,
       CASE WHEN event_type = 'error' THEN 'broken ' || event_id END AS error_message
FROM r
"""


@query(f"""
WITH {RUNS_SQL}
SELECT source, space_key, arg_max(event_type, ts) = 'purchase' AS "full", epoch_us(max(ts)) // 1000 AS start_ms,
       arg_max(event_id % 1000, ts) AS time_elapsed
FROM r GROUP BY source, space_key
""")
def g6_last_run(spark, d):
    return act.last_run(runs(spark, d)).select(
        "source", "space_key", "full", millis(F.col("start_date")).alias("start_ms"), "time_elapsed"
    )


@query(f"""
WITH {RUNS_SQL}, rec AS ({RECORD_SQL}),
last AS (SELECT source, space_key, arg_max(rec, start_date) AS v FROM rec GROUP BY ALL)
SELECT source, 'source' AS section, CAST(NULL AS VARCHAR) AS space_key,
       '{{"source":"' || source || '","info_date":"2024-01-31T00:00:00.000Z","state":"running","last_restart":"2024-01-30T00:00:00.000Z"}}' AS report
FROM s GROUP BY source
UNION ALL
SELECT source, 'indexed_spaces', space_key, '{{"space_key":"' || space_key || '","last_indexing":{{"update_type":"' || v.update_type
  || '","start_date":"' || v.start_date || '","documents_updated":' || v.documents_updated || ',"documents_deleted":' || v.documents_deleted
  || ',"comments_deleted":' || v.comments_deleted || ',"documents_with_error":' || v.documents_with_error || ',"result":"' || v.result
  || '","time_elapsed":"' || v.time_elapsed || '"' || CASE WHEN v.error_message IS NULL THEN '' ELSE ',"error_message":"' || v.error_message || '"' END || '}}}}'
FROM last
UNION ALL
SELECT source, 'indexed_spaces', space_key || 'new', '{{"space_key":"' || space_key || 'new"}}' FROM s WHERE user_id % 3 = 0
UNION ALL
SELECT source, 'current_indexing', space_key, '{{"space_key":"' || space_key || '","update_type":"' || update_type || '","start_date":"' || start_date
  || '","documents_updated":' || documents_updated || ',"documents_deleted":' || documents_deleted || ',"comments_deleted":' || comments_deleted
  || ',"documents_with_error":' || documents_with_error || '}}'
FROM rec WHERE start_date >= '2024-01-30T12'
""")
def g7_state_report(spark, d):
    known, done = spaces(spark, d), runs(spark, d)
    third = F.regexp_extract("space_key", "[0-9]+", 0).cast("bigint") % 3 == 0
    every = known.unionByName(known.filter(third).withColumn("space_key", F.concat("space_key", F.lit("new"))))
    sources = act.list_sources(known).select(
        "source", F.lit(NOW).alias("info_date"), F.lit("running").alias("state"), F.lit(at(2024, 1, 30)).alias("since")
    )
    running = done.filter(F.col("start_date") >= F.lit(at(2024, 1, 30, 12)))
    return act.state_report(sources, running, every, done)


@query(f"WITH {RUNS_SQL} {RECORD_SQL}")
def g8_activity_row(spark, d):
    return act.activity_row(runs(spark, d))


@query(f"""
WITH {RUNS_SQL}
SELECT source, space_key, event_type = 'purchase' AS "full", epoch_us(ts) // 1000 AS start_ms, CAST(floor(value) AS INTEGER) AS documents_updated,
       event_type <> 'error' AS ok, event_id % 1000 AS time_elapsed, CASE WHEN event_type = 'error' THEN 'broken ' || event_id END AS error_message
FROM r
""")
def g9_parse_activity_row(spark, d):
    back = act.parse_activity_row(act.activity_json(runs(spark, d)))
    return back.select(
        "source", "space_key", "full", millis(F.col("start_date")).alias("start_ms"), "documents_updated", "ok", "time_elapsed", "error_message"
    )


@query(f"WITH {RUNS_SQL} SELECT DISTINCT source FROM r")
def g10_list_sources(spark, d):
    return act.list_sources(runs(spark, d))


@query(f"""
WITH {RUNS_SQL}
SELECT 'stopped' AS phase, source, space_key FROM s WHERE source NOT IN ('src0', 'src3')
UNION ALL SELECT 'resumed', source, space_key FROM s WHERE source <> 'src3'
""")
def g12_pause_resume(spark, d):
    known = spaces(spark, d)
    sources = act.list_sources(known)
    stopped = st.pause(state(spark, d), sources.filter("source IN ('src0', 'src3')"), NOW)
    resumed = st.resume(stopped, sources.filter("source = 'src0'"))
    return st.running_sources(known, stopped).select(F.lit("stopped").alias("phase"), "source", "space_key").unionByName(
        st.running_sources(known, resumed).select(F.lit("resumed").alias("phase"), "source", "space_key")
    )


@query(f"WITH {RUNS_SQL} {RECORD_SQL}")
def s23_append_activity(spark, d):
    path = f"{shared_folder(spark)}/activity-{uuid.uuid4().hex}"
    rows = act.activity_row(runs(spark, d))
    full = F.col("update_type") == "FULL"
    sinks.append_activity(rows.filter(full), path)
    sinks.append_activity(rows.filter(~full), path)
    sinks.append_activity(rows, None)
    return spark.read.schema(rows.schema).parquet(path)
