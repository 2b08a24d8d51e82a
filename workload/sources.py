"""S1-S23: payloads, reads, requests, details, sitemaps and sinks."""

from __future__ import annotations

import gzip
import uuid
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from syncspark.operators import sinks
from syncspark.operators.joins import keyed_join
from syncspark.session import shared_folder
from syncspark.sources import details as det, payloads as pl, reads, requests as rq, sitemap as sm
from syncspark.sources.spaces import select_spaces
from workload.base import at, millis, query, table, text

EVENT = T.StructType().add("event_id", "long").add("user_id", "long").add("event_type", "string").add("total", "string")


def payloads(spark, d) -> DataFrame:
    """Response texts of 100 events each: items with a total and a page name around them."""
    events = table(spark, d, "events").withColumn("page_no", F.floor(F.col("event_id") / 100).cast("bigint"))
    item = F.struct("event_id", "user_id", "event_type", F.lit("own").alias("total"))
    pages = events.groupBy("page_no").agg(F.array_sort(F.collect_list(item)).alias("items"))
    body = F.struct(
        F.struct(
            F.col("items"),
            F.when(F.col("page_no") % 2 == 0, F.size("items").cast("string")).alias("total"),
        ).alias("response"),
        F.struct(F.size("items").cast("string").alias("count"), F.concat(F.lit("p"), text("page_no")).alias("name")).alias("meta"),
    )
    return pages.select(
        F.concat(F.lit("S"), (F.col("page_no") % 3).cast("string")).alias("space_key"),
        "page_no",
        (F.col("page_no") * 100).alias("start_at"),
        F.to_json(body).alias("payload"),
        F.to_json("items").alias("list"),
    )


@query("""
SELECT event_id // 100 AS page_no, row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1 AS pos,
       event_id, user_id, event_type, 'own' AS total
FROM events
""")
def s1_extract_documents(spark, d):
    return pl.extract_documents(payloads(spark, d), EVENT, "response.items", carry=["page_no"])


@query("SELECT event_id // 100 AS page_no, count(*) AS total, TRUE AS unconfigured FROM events GROUP BY 1")
def s2_extract_total(spark, d):
    return payloads(spark, d).select(
        "page_no",
        pl.extract_total(F.col("payload"), "meta.count").cast("bigint").alias("total"),
        pl.extract_total(F.col("payload"), None).isNull().alias("unconfigured"),
    )


@query("""
SELECT event_id, 'p' || (event_id // 100) AS page,
       CASE WHEN event_id // 100 % 2 = 0 THEN CAST(count(*) OVER (PARTITION BY event_id // 100) AS VARCHAR) END AS total
FROM events
""")
def s3_broadcast_root_fields(spark, d):
    docs = pl.extract_documents(
        payloads(spark, d), EVENT, "response.items",
        root_fields={"page": ("meta.name", "string"), "total": ("response.total", "string")},
    )
    return docs.select("event_id", "page", "total")


@query("""
SELECT 'list' AS given, CAST(user_id AS VARCHAR) AS space_key FROM events GROUP BY user_id
UNION ALL SELECT 'object', o_orderpriority FROM orders GROUP BY o_orderpriority
""")
def s4_extract_spaces(spark, d):
    pages = table(spark, d, "events").groupBy(F.floor(F.col("event_id") / 100).alias("page")).agg(
        F.to_json(F.struct(F.struct(F.collect_set("user_id").alias("keys")).alias("result"))).alias("payload")
    )
    objects = table(spark, d, "orders").select(
        F.to_json(F.create_map("o_orderpriority", F.struct("o_orderstatus"))).alias("payload")
    )
    listed = pl.extract_spaces(pages, "result.keys").select(F.lit("list").alias("given"), "space_key")
    return listed.unionByName(pl.extract_spaces(objects).select(F.lit("object").alias("given"), "space_key"))


@query("""
SELECT 'all' AS given, o_orderpriority AS space_key FROM orders GROUP BY 2
UNION ALL SELECT 'without', o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '1-URGENT') GROUP BY 2
UNION ALL SELECT 'static', unnest(['A', 'B'])
""")
def s5_select_spaces(spark, d):
    listed = table(spark, d, "orders").select(F.col("o_orderpriority").alias("space_key")).distinct()
    given = {
        "all": select_spaces(listed, " ", ""),
        "without": select_spaces(listed, None, "5-LOW, 1-URGENT,"),
        "static": select_spaces(listed, " A ,,B", "A"),
    }
    out = [df.select(F.lit(name).alias("given"), "space_key") for name, df in given.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'")
def s6_scan_simple(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return reads.scan_simple(orders, "1-URGENT", "o_orderpriority")


@query("""
WITH p AS (SELECT o_custkey % 4 AS s, o_orderkey // 500 AS page_no, count(*) AS n FROM orders GROUP BY ALL),
t AS (SELECT o_custkey % 4 AS s, max(o_orderkey) // 2 AS total FROM orders GROUP BY ALL),
r AS (SELECT p.s, min(page_no) FILTER (p.s < 3 AND total <= page_no * 500 + n) AS stop FROM p JOIN t ON t.s = p.s GROUP BY p.s)
SELECT 'S' || r.s AS space_key, o_orderkey // 500 AS page_no, o_orderkey AS id
FROM orders JOIN r ON r.s = o_custkey % 4 WHERE stop IS NULL OR o_orderkey // 500 <= stop
""")
def s7_scan_pages(spark, d):
    orders = table(spark, d, "orders").select(
        F.concat(F.lit("S"), (F.col("o_custkey") % 4).cast("string")).alias("space_key"),
        F.floor(F.col("o_orderkey") / 500).cast("bigint").alias("page_no"),
        F.col("o_orderkey").alias("id"),
    )
    pages = orders.groupBy("space_key", "page_no").agg(F.array_sort(F.collect_list(F.struct("id"))).alias("documents"))
    totals = orders.filter("space_key <> 'S3'").groupBy("space_key").agg(F.floor(F.max("id") / 2).alias("total"))
    pages = keyed_join(pages, totals, ["space_key"], "left").withColumn("start_at", F.col("page_no") * 500)
    return reads.scan_pages(pages).select("space_key", "page_no", F.col("document.id").alias("id"))


@query("""
SELECT o_orderkey, epoch_us(o_orderdate) // 1000 AS updated_ms FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01'
""")
def s8_scan_updated(spark, d):
    found = reads.scan_updated(table(spark, d, "orders"), "o_orderdate", at(1997, 6, 1))
    return found.select("o_orderkey", millis(F.col("o_orderdate")).alias("updated_ms"))


@query("""
SELECT 'one' AS read, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-06-01' AND TIMESTAMP '1997-06-11'
UNION ALL
SELECT 'slice ' || lpad(CAST((epoch_us(o_orderdate) - epoch_us(TIMESTAMP '1992-01-01')) // 864000000000 AS VARCHAR), 3, '0'),
       count(*), CAST(sum(o_orderkey) AS BIGINT)
FROM orders WHERE o_orderdate >= TIMESTAMP '1992-01-01' GROUP BY 1
""")
def s9_scan_updated_slice(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    span = timedelta(days=10)
    one = reads.scan_updated_slice(orders, "o_orderdate", None, span, initial=at(1997, 6, 1))
    one = one.select(F.lit("one").alias("read"), "o_orderkey")
    start = at(1992, 1, 1)
    later = reads.scan_updated(orders, "o_orderdate", start)
    number = reads.assign_slice(F.col("o_orderdate"), start, span).cast("string")
    all_slices = later.select(F.concat(F.lit("slice "), F.lpad(number, 3, "0")).alias("read"), "o_orderkey")
    return one.unionByName(all_slices).groupBy("read").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("""
WITH s AS (SELECT o_orderpriority AS space_key, epoch_us(max(o_orderdate)) // 1000 AS after_ms FROM orders GROUP BY 1),
r AS (SELECT space_key, after_ms, unnest([TRUE, FALSE]) AS full_run FROM s)
SELECT space_key, full_run,
       'https://x.org/docs?s=' || replace(url_encode(space_key), '%20', '+') || '&after=' || CASE WHEN full_run THEN '' ELSE CAST(after_ms AS VARCHAR) END
       || '&before=' || CASE WHEN full_run THEN '' ELSE CAST(after_ms + 3600000 AS VARCHAR) END || '&at=0&type='
       || CASE WHEN full_run THEN 'full' ELSE 'inc' END || '&key=' AS url
FROM r
""")
def s10_plan_requests(spark, d):
    spaces = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("space_key")).agg(
        F.max(F.col("o_orderdate").cast("timestamp")).alias("after")
    )
    runs = spaces.select("space_key", "after", F.explode(F.array(F.lit(True), F.lit(False))).alias("full_run"))
    after = F.when(~F.col("full_run"), F.col("after"))
    url = rq.plan_requests(
        "https://x.org/docs?s={space}&after={updatedAfter}&before={updatedBefore}&at={startAtIndex}&type={indexingType}&key={apiKey}",
        F.col("space_key"), after, after + F.lit(timedelta(hours=1)), F.lit(0), F.col("full_run"),
    )
    return runs.select("space_key", "full_run", url.alias("url"))


def text_details(spark, d) -> DataFrame:
    """Details of texts: unlabelled ones are not found, toxic ones have none."""
    docs, labels = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels")
    joined = docs.join(labels, "doc_id", "left")
    return joined.select(
        "doc_id",
        F.when(F.col("quality").isNull(), 404).otherwise(200).alias("status"),
        F.when(F.col("toxic") == 0, F.struct("quality")).alias("detail"),
    )


@query("""
SELECT 'found' AS outcome, d.doc_id, CASE WHEN toxic = 0 THEN quality END AS quality
FROM documents d JOIN labels l ON l.doc_id = d.doc_id
UNION ALL SELECT 'error', doc_id, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def s11_enrich_details(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    found, errors = det.enrich_details(docs, text_details(spark, d), ["doc_id"])
    return found.select(F.lit("found").alias("outcome"), "doc_id", F.col("detail.quality").alias("quality")).unionByName(
        errors.select(F.lit("error").alias("outcome"), "doc_id", F.lit(None).cast("int").alias("quality"))
    )


@query("""
SELECT page_id, 'https://x.org/S%2F1/' || page_id || '+x' AS by_template, CASE WHEN page_id % 3 <> 0 THEN url END AS by_field FROM pages
""")
def s12_plan_detail_urls(spark, d):
    pages = table(spark, d, "pages")
    field = F.when(F.col("page_id") % 3 != 0, F.concat(F.lit(" "), F.col("url"))).when(
        F.col("page_id") % 2 == 0, F.lit("no url")
    )
    return pages.select(
        "page_id",
        rq.plan_detail_urls(F.concat(text("page_id"), F.lit(" x")), F.lit("S/1"), template="https://x.org/{space}/{id}").alias("by_template"),
        rq.plan_detail_urls(text("page_id"), F.lit("S"), url_field=field).alias("by_field"),
    )


# --- sitemaps -------------------------------------------------------------------


def _xml(value: Column) -> Column:
    return F.replace(value, F.lit("&"), F.lit("&amp;"))


def listed_pages(spark, d) -> DataFrame:
    """Pages of a site put under one directory, a hundred to a sitemap."""
    path = F.regexp_replace("url", r"^https?://", "")
    return table(spark, d, "pages").select(
        "page_id",
        F.floor(F.col("page_id") / 100).cast("bigint").alias("sitemap"),
        F.concat(F.lit("http://site.org/"), text("page_id"), F.lit("/"), path).alias("url"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 300).cast("int")).cast("string").alias("day"),
        (F.col("page_id") % 20 / 10).cast("string").alias("prio"),
    )


def bodies(spark, d, kind: str, entry, opening: str, closing: str, suffix: str) -> DataFrame:
    """One body per hundred pages, so no body grows with the table."""
    pages = listed_pages(spark, d).select("sitemap", F.struct("page_id", entry.alias("entry")).alias("item"))
    grouped = pages.groupBy("sitemap").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return grouped.select(
        F.concat(F.lit("http://Site.org/map"), text("sitemap"), F.lit(suffix)).alias("sitemap_url"),
        F.lit(kind).alias("content_type"),
        F.concat(F.lit(opening), F.array_join("items.entry", "\n"), F.lit(closing)).alias("body"),
    )


def xml_bodies(spark, d) -> DataFrame:
    bad = F.col("page_id") % 10 == 9
    outside = F.col("page_id") % 10 == 8
    loc = F.when(bad, "not a url").when(outside, F.concat(F.lit("http://other.org/"), text("page_id"))).otherwise(F.col("url"))
    entry = F.concat(
        F.lit("<url><loc> "), _xml(loc), F.lit("</loc><lastmod>"), F.col("day"), F.lit("</lastmod><changefreq>Weekly</changefreq><priority>"),
        F.col("prio"), F.lit("</priority></url>"),
    )
    return bodies(
        spark, d, "text/xml", entry,
        '<?xml version="1.0" encoding="UTF-8"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">', "</urlset>", ".xml",
    )


def text_bodies(spark, d) -> DataFrame:
    line = F.when(F.col("page_id") % 10 == 9, "").when(F.col("page_id") % 10 == 8, "no url").otherwise(F.col("url"))
    return bodies(spark, d, "text/plain", line, "", "", ".txt")


def atom_bodies(spark, d) -> DataFrame:
    entry = F.concat(
        F.lit("<entry><title>x</title><link href=\""), F.when(F.col("page_id") % 10 == 9, "").otherwise(_xml(F.col("url"))),
        F.lit("\"/></entry>"),
    )
    return bodies(spark, d, "application/atom+xml", entry, "<feed><modified>2011-03-04</modified>", "</feed>", "-atom.xml")


def rss_bodies(spark, d) -> DataFrame:
    item = F.concat(F.lit("<item><link>"), F.when(F.col("page_id") % 10 == 9, "").otherwise(_xml(F.col("url"))), F.lit("</link></item>"))
    return bodies(
        spark, d, "application/rss+xml", item,
        '<rss version="2.0"><channel><pubDate>Mon, 16 May 2016 09:30:00 GMT</pubDate>', "</channel></rss>", "-rss.xml",
    )


def shown(urls: DataFrame) -> DataFrame:
    return urls.select(
        "sitemap_url", "pos", "url", millis(F.col("last_modified")).alias("modified_ms"), "change_freq", "priority", "valid"
    )


def sitemap_sql(suffix: str, keep: str, modified: str, freq: str = "CAST(NULL AS VARCHAR)", prio: str = "CAST(0.5 AS DOUBLE)") -> str:
    return f"""
SELECT 'http://Site.org/map' || (page_id // 100) || '{suffix}' AS sitemap_url,
       row_number() OVER (PARTITION BY page_id // 100 ORDER BY page_id) - 1 AS pos,
       'http://site.org/' || page_id || '/' || regexp_replace(url, '^https?://', '') AS url,
       {modified} AS modified_ms, {freq} AS change_freq, {prio} AS priority, TRUE AS valid
FROM pages WHERE {keep}
"""


XML_SQL = sitemap_sql(
    ".xml", "page_id % 10 < 8", "epoch_us(TIMESTAMP '2024-01-01' + to_days(CAST(page_id % 300 AS INTEGER))) // 1000",
    "'WEEKLY'", "CASE WHEN page_id % 20 <= 10 THEN page_id % 20 / CAST(10 AS DOUBLE) ELSE 0.5 END",
)
TEXT_SQL = sitemap_sql(".txt", "page_id % 10 < 8", "CAST(NULL AS BIGINT)")
ATOM_SQL = sitemap_sql("-atom.xml", "page_id % 10 < 9", "epoch_us(TIMESTAMP '2011-03-04') // 1000")
RSS_SQL = sitemap_sql("-rss.xml", "page_id % 10 < 9", "epoch_us(TIMESTAMP '2016-05-16 09:30:00') // 1000")


@query(" UNION ALL ".join(f"({sql})" for sql in (XML_SQL, TEXT_SQL, ATOM_SQL, RSS_SQL)))
def s13_read_sitemap(spark, d):
    mixed = xml_bodies(spark, d).unionByName(text_bodies(spark, d)).unionByName(atom_bodies(spark, d)).unionByName(rss_bodies(spark, d))
    return shown(sm.read_sitemap(mixed))


@query(XML_SQL)
def s14_sitemap_xml(spark, d):
    return shown(sm.sitemap_xml(xml_bodies(spark, d)))


@query(TEXT_SQL)
def s15_sitemap_text(spark, d):
    return shown(sm.sitemap_text(text_bodies(spark, d)))


@query(XML_SQL.replace(".xml", ".gz"))
def s16_sitemap_gzip(spark, d):
    def squeeze(batch: pd.Series) -> pd.Series:
        return batch.map(lambda s: gzip.compress(s.encode("utf-8")))

    zipped = F.pandas_udf(squeeze, "binary")
    packed = xml_bodies(spark, d).select(
        F.regexp_replace("sitemap_url", r"\.xml$", ".gz").alias("sitemap_url"),
        F.lit("application/x-gzip").alias("content_type"),
        F.lit(None).cast("string").alias("body"),
        zipped("body").alias("content"),
    )
    return shown(sm.read_sitemap(packed))


@query(ATOM_SQL)
def s17_sitemap_atom(spark, d):
    return shown(sm.sitemap_atom(atom_bodies(spark, d)))


@query(RSS_SQL)
def s18_sitemap_rss(spark, d):
    return shown(sm.sitemap_rss(rss_bodies(spark, d)))


@query("""
SELECT 'http://Site.org/map' || (page_id // 100) || '-index.xml' AS sitemap_url,
       row_number() OVER (PARTITION BY page_id // 100 ORDER BY page_id) - 1 AS pos,
       'http://site.org/' || page_id || '/' || regexp_replace(url, '^https?://', '') || '.gz' AS url,
       CASE WHEN page_id % 2 = 0 THEN epoch_us(TIMESTAMP '2024-01-01' + to_days(CAST(page_id % 300 AS INTEGER))) // 1000 + 25689000 END AS modified_ms
FROM pages WHERE page_id % 10 < 9
""")
def s19_sitemap_index(spark, d):
    loc = F.when(F.col("page_id") % 10 == 9, "bad").otherwise(F.concat(_xml(F.col("url")), F.lit(".gz")))
    stamp = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<lastmod>"), F.col("day"), F.lit("T07:08:09+00:00</lastmod>"))).otherwise("")
    entry = F.concat(F.lit("<sitemap><loc>"), loc, F.lit("</loc>"), stamp, F.lit("</sitemap>"))
    index = bodies(spark, d, "text/xml", entry, "<sitemapindex>", "</sitemapindex>", "-index.xml")
    found = sm.sitemap_index(index)
    return found.select("sitemap_url", "pos", "url", millis(F.col("last_modified")).alias("modified_ms"))


DOC_ID_SQL = r"translate(replace(u, '://', '_'), ':.=\/?&%*$#@+<>', '_______________')"


@query(f"""
WITH e AS (SELECT page_id, page_id // 100 AS s, 'http://site.org/' || page_id || '/' || regexp_replace(url, '^https?://', '') AS u FROM pages),
twice AS (SELECT s, u, page_id, page_id AS pos FROM e UNION ALL SELECT s, u || '.JPG', page_id, page_id + 1000000 FROM e
          UNION ALL SELECT s, u, page_id + 1, page_id + 2000000 FROM e WHERE page_id % 2 = 0)
SELECT {DOC_ID_SQL} AS id, u AS url, strftime(TIMESTAMP '2024-01-01' + to_days(CAST(p % 300 AS INTEGER)), '%Y-%m-%dT00:00:00.0+0000') AS last_modified,
       CAST(0.5 AS DOUBLE) AS priority
FROM (SELECT s, u, arg_max(page_id, pos) AS p FROM twice WHERE u NOT LIKE '%.JPG' GROUP BY s, u)
""")
def s20_website_documents(spark, d):
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), (n % 300).cast("int")).cast("timestamp")
    base = listed_pages(spark, d)
    page = F.col("page_id")

    def entries(rows, url, number, pos):
        return rows.select(
            text("sitemap").alias("sitemap_url"), pos.alias("pos"), url.alias("url"), day(number).alias("last_modified"),
            F.lit(0.5).alias("priority"),
        )

    urls = (
        entries(base, F.col("url"), page, page)
        .unionByName(entries(base, F.concat("url", F.lit(".JPG")), page, page + 1_000_000))
        .unionByName(entries(base.filter(page % 2 == 0), F.col("url"), page + 1, page + 2_000_000))
    )
    return sm.website_documents(urls)


# --- sinks ----------------------------------------------------------------------


@query("""
SELECT 'written' AS outcome, o_orderkey FROM orders WHERE o_totalprice <= 400000
UNION ALL SELECT 'refused', o_orderkey FROM orders WHERE NOT (o_totalprice <= 400000)
UNION ALL SELECT 'counted', count(*) FROM orders WHERE o_totalprice <= 400000
""")
def s22_write_documents(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    folder = f"{shared_folder(spark)}/write-{uuid.uuid4().hex}"
    result = sinks.write_documents(rows, F.col("o_totalprice") <= 400000, folder, ["o_orderpriority"])
    written = sinks.stored(spark, folder, rows.schema).select(F.lit("written").alias("outcome"), "o_orderkey")
    counted = spark.range(1).select(F.lit("counted").alias("outcome"), F.lit(result.written).alias("o_orderkey"))
    refused = sinks.stored(spark, folder, rows.schema, refused=True).select(F.lit("refused").alias("outcome"), "o_orderkey")
    return written.unionByName(counted).unionByName(refused)
