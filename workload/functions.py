"""F1-F24: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from syncspark.functions import dates, paths, text as txt, urls
from syncspark.operators.changes import document_updated, require_updated
from workload.base import millis, query, table, text


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS nested, CAST(NULL AS VARCHAR) AS missing
FROM events
""")
def f1_path(spark, d):
    events = table(spark, d, "events").select(
        "event_id",
        F.parse_json("props").alias("v"),
        F.struct(F.from_json("props", "k bigint").alias("inner")).alias("doc"),
    )
    return events.select(
        "event_id",
        paths.variant_path(F.col("v"), "k", "bigint").alias("k"),
        paths.struct_path(events.schema, "doc.inner.k").alias("nested"),
        paths.variant_path(F.col("v"), "a.b").alias("missing"),
    )


@query("SELECT event_id, CAST(user_id AS VARCHAR) AS id, json_extract_string(props, '$.k') AS variant_id FROM events")
def f2_document_id(spark, d):
    events = table(spark, d, "events")
    docs = events.select(
        "event_id", F.struct("user_id").alias("meta"), F.variant_get(F.parse_json("props"), "$.k", "variant").alias("k")
    )
    return docs.select(
        "event_id",
        paths.document_id(docs.schema, "meta.user_id").alias("id"),
        paths.document_id(docs.schema, "k").alias("variant_id"),
    )


@query("SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS id FROM orders")
def f3_require_document_id(spark, d):
    orders = table(spark, d, "orders")
    checked = paths.require_document_id(text("o_orderkey"), F.col("o_orderpriority"))
    return orders.select("o_orderkey", checked.alias("id"))


@query("SELECT o_orderkey, epoch_us(date_trunc('day', o_orderdate)) // 1000 AS updated_ms FROM orders")
def f4_document_updated(spark, d):
    docs = table(spark, d, "orders").select(
        "o_orderkey", F.struct(F.date_format("o_orderdate", "dd/MM/yyyy").alias("updated")).alias("fields")
    )
    updated = require_updated(document_updated(docs.schema, "fields.updated", "dd/MM/YYYY"), text("o_orderkey"))
    return docs.select("o_orderkey", millis(updated).alias("updated_ms"))


@query("""
SELECT event_id, event_type = 'error' AS deleted, event_type = 'ERROR' AS wrong_case, event_id % 2 = 0 AS flagged FROM events
""")
def f5_document_deleted(spark, d):
    docs = table(spark, d, "events").withColumn("even", F.col("event_id") % 2 == 0)
    return docs.select(
        "event_id",
        paths.document_deleted(docs.schema, "event_type", "error").alias("deleted"),
        paths.document_deleted(docs.schema, "event_type", "ERROR").alias("wrong_case"),
        paths.document_deleted(docs.schema, "even", "true").alias("flagged"),
    )


@query("""
SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE epoch_us(ts) // 1000 END AS by_default,
       epoch_us(ts) // 1000 AS by_millis, epoch_us(ts) // 1000000 * 1000 AS by_seconds,
       epoch_us(date_trunc('minute', ts)) // 1000 AS by_pattern
FROM events
""")
def f6_parse_datetime(spark, d):
    ts = F.col("ts").cast("timestamp")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS"
    given = (
        F.when(F.col("event_id") % 4 == 0, F.unix_millis(ts).cast("string"))
        .when(F.col("event_id") % 4 == 1, F.concat(F.date_format(ts - F.expr("interval 4 hours"), iso), F.lit("-0400")))
        .when(F.col("event_id") % 4 == 2, F.concat(F.date_format(ts + F.expr("interval 90 minutes"), iso), F.lit("+01:30")))
        .otherwise(F.lit("nonsense"))
    )
    events = table(spark, d, "events").select(
        "event_id",
        given.alias("given"),
        F.unix_millis(ts).cast("string").alias("ms"),
        F.unix_seconds(ts).cast("string").alias("s"),
        F.date_format(ts, "yyyy.MM.dd HH:mm").alias("p"),
    )
    return events.select(
        "event_id",
        millis(dates.parse_datetime(F.col("given"))).alias("by_default"),
        millis(dates.parse_datetime(F.col("ms"), dates.MILLISECOND_EPOCH)).alias("by_millis"),
        millis(dates.parse_datetime(F.col("s"), dates.UNIX_EPOCH)).alias("by_seconds"),
        millis(dates.parse_datetime(F.col("p"), "YYYY.MM.dd HH:mm")).alias("by_pattern"),
    )


ISO_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S.') || CAST(epoch_us(ts) // 1000 % 1000 AS VARCHAR) || '+0000'"


@query(f"""
SELECT event_id, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ms, CAST(epoch_us(ts) // 1000000 AS VARCHAR) AS s,
       strftime(ts, '%Y-%m-%d') AS day, {ISO_SQL} AS iso
FROM events
""")
def f7_format_datetime(spark, d):
    ts = F.col("ts")
    return table(spark, d, "events").select(
        "event_id",
        dates.format_datetime(ts, dates.MILLISECOND_EPOCH).alias("ms"),
        dates.format_datetime(ts, dates.UNIX_EPOCH).alias("s"),
        dates.format_datetime(ts, "YYYY-MM-dd").alias("day"),
        dates.format_datetime(ts, " ").alias("iso"),
    )


@query(f"SELECT event_id, {ISO_SQL} AS iso FROM events")
def f8_format_iso(spark, d):
    return table(spark, d, "events").select("event_id", dates.format_iso(F.col("ts")).alias("iso"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE epoch_us(date_trunc('day', o_orderdate)) // 1000 END AS ms
FROM orders
""")
def f9_parse_iso(spark, d):
    given = F.when(F.col("o_orderkey") % 5 == 0, " ").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, d, "orders").select("o_orderkey", millis(dates.parse_iso(given)).alias("ms"))


@query("""
SELECT event_id, epoch_us(date_trunc('minute', ts)) // 1000 AS rounded, epoch_us(date_trunc('minute', ts)) // 1000 AS parsed
FROM events
""")
def f10_round_to_minute(spark, d):
    ts = F.col("ts").cast("timestamp")
    return table(spark, d, "events").select(
        "event_id",
        millis(dates.round_to_minute(ts)).alias("rounded"),
        millis(dates.parse_iso_minute(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"))).alias("parsed"),
    )


@query(r"""
WITH t AS (SELECT doc_id, nullif(regexp_replace(regexp_replace(text, '^[\x00-\x20]+', ''), '[\x00-\x20]+\z', ''), '') AS s
           FROM documents)
SELECT doc_id, s AS trimmed, s IS NULL AS blank, doc_id % 3 = 0 OR s IS NULL AS padded_blank FROM t
""")
def f11_trim_to_null(spark, d):
    padded = F.concat(F.lit(" \t\r\n"), F.col("text"), F.lit("\n\x01 "))
    third = F.when(F.col("doc_id") % 3 == 0, F.lit(" \n\t ")).otherwise(F.col("text"))
    return table(spark, d, "documents").select(
        "doc_id",
        txt.trim_to_null(padded).alias("trimmed"),
        txt.is_blank(F.col("text")).alias("blank"),
        txt.is_blank(third).alias("padded_blank"),
    )


@query("""
SELECT p_partkey,
       nullif(array_to_string(list_filter(list_transform(string_split(replace(p_name, ' ', ' , ,'), ','),
              lambda x: trim(x)), lambda x: x <> ''), '|'), '') AS tokens
FROM part
""")
def f12_parse_csv(spark, d):
    given = F.replace(F.col("p_name"), F.lit(" "), F.lit(" , ,"))
    return table(spark, d, "part").select("p_partkey", F.array_join(txt.parse_csv(given), "|").alias("tokens"))


@query("""
SELECT p_partkey, p_brand || ',null,' || p_type AS csv, '' AS empty, CAST(NULL AS VARCHAR) AS nothing FROM part
""")
def f13_create_csv(spark, d):
    none = F.lit(None).cast("string")
    return table(spark, d, "part").select(
        "p_partkey",
        txt.create_csv(F.array(F.col("p_brand"), none, F.col("p_type"))).alias("csv"),
        txt.create_csv(F.array().cast("array<string>")).alias("empty"),
        txt.create_csv(F.lit(None).cast("array<string>")).alias("nothing"),
    )


@query(r"""
SELECT page_id, nullif(lower(regexp_extract(url, '^.+\.([^./]+)$', 1)), '') AS ext,
       nullif(lower(regexp_extract(url || '.JPG', '^.+\.([^./]+)$', 1)), '') AS ext2
FROM pages
""")
def f14_file_extension(spark, d):
    return table(spark, d, "pages").select(
        "page_id",
        urls.file_extension(F.col("url")).alias("ext"),
        urls.file_extension(F.concat(F.col("url"), F.lit(".JPG "))).alias("ext2"),
    )


@query(r"""
SELECT page_id, translate(replace(url, '://', '_'), ':.=\/?&%*$#@+<>', '_______________') AS id FROM pages
""")
def f15_url_to_id(spark, d):
    return table(spark, d, "pages").select("page_id", urls.url_to_id(F.col("url")).alias("id"))


@query("""
SELECT page_id, starts_with(lower(url), 'https://blog.') AS blog, starts_with(lower(url), 'http://m.') AS mobile FROM pages
""")
def f16_url_allowed(spark, d):
    return table(spark, d, "pages").select(
        "page_id",
        urls.url_allowed(F.lit("HTTPS://Blog."), F.col("url")).alias("blog"),
        urls.url_allowed(F.lit("http://m."), F.upper("url")).alias("mobile"),
    )


@query("SELECT page_id, regexp_replace(lower(url), '/[^/]*$', '/') AS base FROM pages")
def f17_sitemap_base(spark, d):
    return table(spark, d, "pages").select("page_id", urls.sitemap_base(F.col("url")).alias("base"))


@query("SELECT page_id, page_id % 4 IN (0, 2) AS valid FROM pages")
def f18_valid_url(spark, d):
    kind = F.col("page_id") % 4
    given = (
        F.when(kind == 0, F.col("url"))
        .when(kind == 1, F.regexp_replace("url", "^https?", "what"))
        .when(kind == 2, F.concat(F.regexp_replace("url", "^https?", "FTP"), F.lit(" x")))
        .otherwise(F.regexp_replace("url", r"^(https?://[^/]+)", "$1:port"))
    )
    return table(spark, d, "pages").select("page_id", urls.valid_url(given).alias("valid"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 7 = 0 OR p_size > 25 THEN CAST(0.5 AS DOUBLE) ELSE p_size / CAST(25 AS DOUBLE) END AS priority
FROM part
""")
def f19_priority(spark, d):
    given = F.when(F.col("p_size") % 7 == 0, "high").otherwise((F.col("p_size") / 25).cast("string"))
    return table(spark, d, "part").select("p_partkey", urls.priority(given).alias("priority"))


@query("""
SELECT p_partkey, (['ALWAYS', 'HOURLY', 'DAILY', 'WEEKLY', 'MONTHLY', 'YEARLY', 'NEVER', NULL, NULL])[p_size % 9 + 1] AS freq
FROM part
""")
def f20_change_freq(spark, d):
    given = F.array(*[F.lit(v) for v in ("Always, not never", "hourly", "x-daily", "Weekly", "MONTHLY", "yearly!", "never", "often", None)])
    return table(spark, d, "part").select(
        "p_partkey", urls.change_freq(F.element_at(given, (F.col("p_size") % 9 + 1).cast("int"))).alias("freq")
    )


@query("""
SELECT event_id,
  CASE event_id % 6 WHEN 5 THEN NULL
    WHEN 0 THEN epoch_us(date_trunc('day', ts)) // 1000 WHEN 4 THEN epoch_us(date_trunc('day', ts)) // 1000
    WHEN 1 THEN epoch_us(date_trunc('minute', ts)) // 1000
    ELSE epoch_us(date_trunc('second', ts)) // 1000 END AS ms
FROM events
""")
def f21_sitemap_lastmod(spark, d):
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_id") % 6
    given = (
        F.when(kind == 0, F.date_format(ts, "yyyy-MM-dd"))
        .when(kind == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm+02:00"))
        .when(kind == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss-05:00"))
        .when(kind == 3, F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .when(kind == 4, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise("soon")
    )
    return table(spark, d, "events").select("event_id", millis(dates.sitemap_lastmod(given)).alias("ms"))


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS from_text, CAST(trunc(value) AS INTEGER) AS from_number,
       CAST(NULL AS INTEGER) AS unusable
FROM events
""")
def f22_node_int(spark, d):
    return table(spark, d, "events").select(
        "event_id",
        txt.node_int(F.get_json_object("props", "$.k")).alias("from_text"),
        txt.node_int(F.col("value"), numeric=True).alias("from_number"),
        txt.node_int(F.col("event_type"), strict=False).alias("unusable"),
    )


@query("""
SELECT event_id, TRUE AS user_simple, TRUE AS type_simple, FALSE AS value_simple, FALSE AS props_simple FROM events
""")
def f23_is_simple(spark, d):
    doc = F.parse_json(F.to_json(F.struct("user_id", "event_type", "value", F.from_json("props", "k bigint").alias("props"))))
    docs = table(spark, d, "events").select("event_id", doc.alias("doc"))

    def simple(name):
        return paths.is_simple(F.variant_get("doc", f"$.{name}", "variant"))

    return docs.select(
        "event_id",
        simple("user_id").alias("user_simple"),
        simple("event_type").alias("type_simple"),
        simple("value").alias("value_simple"),
        simple("props").alias("props_simple"),
    )


@query(f"SELECT event_id, {ISO_SQL} AS updated, epoch_us(ts) // 1000 AS stamp FROM events")
def f24_long_to_iso(spark, d):
    docs = table(spark, d, "events").select("event_id", F.struct(millis(F.col("ts")).alias("stamp")).alias("meta"))
    out = dates.long_to_iso(docs, "meta.stamp", "meta.updated")
    return out.select("event_id", F.col("meta.updated").alias("updated"), F.col("meta.stamp").alias("stamp"))
