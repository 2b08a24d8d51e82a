import gzip
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from syncspark.errors import ConfigError
from syncspark.functions.dates import format_iso
from syncspark.plans.website import website
from syncspark.sources import details as det, payloads as pl, reads, requests as rq, sitemap as sm
from syncspark.sources.spaces import select_spaces

DOC = T.StructType().add("key", "string").add("total", "string")


def payload_rows(spark, *texts):
    return spark.createDataFrame([("S", i, t) for i, t in enumerate(texts)], "space_key string, page_no int, payload string")


def test_documents_at_the_root(spark):
    rows = pl.extract_documents(payload_rows(spark, '[{"key":"a"},{"key":"b"}]', "[]"), DOC).collect()
    assert [(r.page_no, r.pos, r.key) for r in rows] == [(0, 0, "a"), (0, 1, "b")]


def test_documents_below_a_path_with_root_fields(spark):
    text = '{"response": {"items": [{"key":"a","total":"own"},{"key":"b"}], "total": 20, "nil": null}}'
    rows = pl.extract_documents(
        payload_rows(spark, text), DOC, "response.items",
        {"total": ("response.nil", "string"), "size": ("response.total", "int")},
    ).collect()
    assert [(r.key, r.total, r["size"]) for r in rows] == [("a", None, 20), ("b", None, 20)]


@pytest.mark.parametrize("text, path", [('{"key":"a"}', None), ('[{"key":"a"}]', "items"), ('{"items": {"key": "a"}}', "items"), ("x", None), ('{"items": null}', "items")])
def test_wrong_shape_fails(spark, text, path):
    with pytest.raises(Exception, match="no array of documents"):
        pl.extract_documents(payload_rows(spark, text), DOC, path).collect()


def test_total(spark):
    rows = payload_rows(spark, '{"r": {"total": 5}}', '{"r": {"total": "7"}}')
    assert [r[0] for r in rows.select(pl.extract_total(F.col("payload"), "r.total")).collect()] == [5, 7]
    assert rows.select(pl.extract_total(F.col("payload"), None)).first()[0] is None
    for bad, message in (('{"r": {}}', "no value"), ('{"r": {"total": "x"}}', "not a whole number")):
        with pytest.raises(Exception, match=message):
            payload_rows(spark, bad).select(pl.extract_total(F.col("payload"), "r.total")).collect()


def test_spaces(spark):
    def found(text, path=None):
        return sorted(r.space_key for r in pl.extract_spaces(payload_rows(spark, text), path).collect())

    assert found('["A", 5]') == ["5", "A"]
    assert found('{"A": {}, "B": 1}') == ["A", "B"]
    assert found('{"r": {"s": ["A"]}}', "r.s") == ["A"]
    for bad, path in (('"A"', None), ('["A"]', "r")):
        with pytest.raises(Exception, match="no list of spaces"):
            found(bad, path)


def test_select_spaces(spark):
    listed = spark.createDataFrame([("A",), ("B",), ("C",)], "space_key string")

    def chosen(*args):
        return sorted(r.space_key for r in select_spaces(listed, *args).collect())

    assert chosen(None, " B , ,") == ["A", "C"]
    assert chosen(" X, A", "A") == ["A", "X"]
    assert chosen("", None) == ["A", "B", "C"]


def test_pages_stop(spark):
    def read(*pages):
        df = spark.createDataFrame(
            [(p[0], p[1], p[2], p[3], [{"id": i} for i in p[4]]) for p in pages],
            "space_key string, page_no int, start_at int, total int, documents array<struct<id:string>>",
        )
        return sorted((r.space_key, r.document.id) for r in reads.scan_pages(df).collect())

    assert read(("A", 0, 0, None, "ab"), ("A", 1, 2, None, ""), ("A", 2, 2, None, "c"), ("B", 0, 0, None, "d")) == [
        ("A", "a"), ("A", "b"), ("B", "d"),
    ]
    assert read(("A", 0, 0, 3, "ab"), ("A", 1, 2, 3, "c"), ("A", 2, 3, 3, "d")) == [("A", "a"), ("A", "b"), ("A", "c")]


def test_update_bounds_are_inclusive_and_pushed_down(spark, tmp_path):
    spark.sql("SELECT id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id AS int)) AS ts FROM range(48)").write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    at = datetime(2024, 1, 2)
    later = reads.scan_updated(docs, "ts", at)
    assert later.count() == 24 and reads.scan_updated(docs, "ts", None).count() == 48
    plan = later._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in plan
    assert reads.scan_updated_slice(docs, "ts", at, timedelta(hours=3)).count() == 4
    assert reads.scan_updated_slice(docs, "ts", None, timedelta(hours=3), initial=at).count() == 4
    assert reads.scan_updated_slice(docs, "ts", None, timedelta(hours=3)).count() == 48


def test_slices_cover_a_range(spark):
    start = datetime.fromisoformat("2024-01-01T00:00:00+00:00")
    spaces = spark.createDataFrame([("A",)], "space_key string")
    slices = reads.update_slices(spaces, start, start + timedelta(hours=25), timedelta(hours=10))
    rows = slices.select("slice", F.date_format("updated_after", "dd HH").alias("a"), F.date_format("updated_before", "dd HH").alias("b")).collect()
    assert [tuple(r) for r in rows] == [(0, "01 00", "01 10"), (1, "01 10", "01 20"), (2, "01 20", "02 06")]
    got = spark.sql("SELECT timestamp'2024-01-01 10:00:00' AS t").select(reads.assign_slice(F.col("t"), start, timedelta(hours=10))).first()[0]
    assert got == 1


def test_request_urls(spark):
    """Each place of the template is filled, encoded, and empty where there is no value."""
    template = "https://api.test/v2/{space}/changes?from={updatedAfter}&to={updatedBefore}&skip={startAtIndex}&mode={indexingType}&token={apiKey}"
    ts = F.lit("2020-02-29 12:00:00.5").cast("timestamp")
    none = F.lit(None).cast("timestamp")

    def url(after, before, start, full, **options):
        return spark.range(1).select(rq.plan_requests(template, F.lit("R&D 1"), after, before, F.lit(start), F.lit(full), **options)).first()[0]

    assert url(none, none, 0, True) == "https://api.test/v2/R%26D+1/changes?from=&to=&skip=0&mode=full&token="
    filled = url(ts, ts + F.lit(timedelta(hours=1)), 300, False, api_key="s3")
    assert filled == "https://api.test/v2/R%26D+1/changes?from=1582977600500&to=1582981200500&skip=300&mode=inc&token=s3"
    assert "from=2020-02-29&" in url(ts, none, 0, False, date_format="YYYY-MM-dd")


def test_detail_urls(spark):
    df = spark.sql("SELECT 'a b' AS id, ' http://x.org/1 ' AS good, 'nope' AS bad, cast(null AS string) AS gone")
    out = df.select(
        rq.plan_detail_urls(F.col("id"), F.lit("S/1"), template="http://x.org/{space}/{id}"),
        *[rq.plan_detail_urls(F.col("id"), F.lit("S"), url_field=F.col(c)) for c in ("good", "bad", "gone")],
        rq.plan_detail_urls(F.col("id"), F.lit("S")),
    ).first()
    assert tuple(out) == ("http://x.org/S%2F1/a+b", "http://x.org/1", None, None, None)
    with pytest.raises(ConfigError):
        rq.plan_detail_urls(F.col("id"), F.lit("S"), template="t", url_field=F.col("good"))


def test_details(spark):
    docs = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    details = spark.createDataFrame([("a", 200, "x"), ("b", 404, None), ("c", 200, None)], "id string, status int, detail string")
    found, errors = det.enrich_details(docs, details, ["id"])
    assert sorted((r.id, r.detail) for r in found.collect()) == [("a", "x"), ("c", None), ("d", None)]
    assert [r.id for r in errors.collect()] == ["b"]


# --- sitemaps -------------------------------------------------------------------

SITE = "https://shop.test/map.xml"
NS = ' xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'

# (address, date, how often it changes, priority) as written, and as read.
ITEMS = [
    ("https://shop.test/p/0", None, None, None), ("https://shop.test/p/1?a=b&c", "2019-07-08", "daily", "1.0"),
    ("no address", "2019-07-08", None, None), ("https://shop.test/p/2", "2021-11-30T23:59:00+02:00", "never", "0.05"),
    ("https://elsewhere.test/p/3", None, "hourly", None), ("https://shop.test/p/4", None, "now and then", "7"),
]
XML_ROWS = [
    ("https://shop.test/p/0", None, None, 0.5, True), ("https://shop.test/p/1?a=b&c", "2019-07-08T00:00:00.0+0000", "DAILY", 1.0, True),
    ("https://shop.test/p/2", "2021-11-30T23:59:00.0+0000", "NEVER", 0.05, True), ("https://shop.test/p/4", None, None, 0.5, True),
]


def tagged(tag, value):
    return "" if value is None else f"<{tag}>{value.replace('&', '&amp;')}</{tag}>"


def urlset(ns=NS, items=ITEMS):
    rows = "".join("<url>" + "".join(map(tagged, ("loc", "lastmod", "changefreq", "priority"), item)) + "</url>\n" for item in items)
    return f'<?xml version="1.0" encoding="UTF-8"?><urlset{ns}>{rows}</urlset>'


def site(spark, text, content_type="text/xml", url=SITE, content=None):
    return spark.createDataFrame(
        [(url, content_type, text, content)], "sitemap_url string, content_type string, body string, content binary"
    )


def entries(df):
    cols = df.select("url", format_iso(F.col("last_modified")).alias("m"), "change_freq", "priority", "valid", "pos")
    return [tuple(r)[:5] for r in cols.orderBy("pos").collect()]


@pytest.mark.parametrize("text", [urlset(), urlset(""), "﻿" + urlset().replace('<?xml version="1.0" encoding="UTF-8"?>', "")])
def test_xml_sitemap(spark, text):
    assert entries(sm.read_sitemap(site(spark, text))) == XML_ROWS
    assert entries(sm.read_sitemap(site(spark, text, None))) == XML_ROWS


def test_gzip_sitemap(spark, tmp_path):
    packed = gzip.compress(urlset().encode())
    assert entries(sm.read_sitemap(site(spark, None, "application/x-gzip", SITE + ".gz", packed))) == XML_ROWS
    (tmp_path / "m.xml.gz").write_bytes(packed)
    files = sm.read_gzip_files(spark, str(tmp_path / "*.gz")).withColumn("sitemap_url", F.lit(SITE + ".gz"))
    assert entries(sm.read_sitemap(files)) == XML_ROWS


def test_lenient_mode_marks_urls_of_other_places(spark):
    rows = entries(sm.read_sitemap(site(spark, urlset()), strict=False))
    assert [r[4] for r in rows] == [True, True, True, False, True] and rows[3][0] == "https://elsewhere.test/p/3"
    assert entries(sm.read_sitemap(site(spark, urlset(), url="https://shop.test/q/map.xml"))) == []


def test_text_sitemap(spark):
    lines = [item[0] for item in ITEMS]
    for end in ("\n", "\r\n", "\r"):
        rows = entries(sm.read_sitemap(site(spark, end.join(["", *lines, "", lines[0]]), "text/plain", "https://shop.test/map.txt")))
        assert [r[0] for r in rows] == [*(x for x in lines if x.startswith("https://shop.test/")), lines[0]]
        assert {r[1:] for r in rows} == {(None, None, 0.5, True)}


def feed(kind, links):
    links = [x.replace("&", "&amp;") for x in links]
    if kind == "atom":
        return "<feed><modified>2018-02-03</modified>" + "".join(f'<entry><link href="{x}"/></entry>' for x in links) + "</feed>"
    return "<rss><channel><pubDate>Sat, 03 Feb 2018 00:00:00 GMT</pubDate>" + "".join(f"<item><link>{x}</link></item>" for x in links) + "</channel></rss>"


@pytest.mark.parametrize("kind", ["atom", "rss"])
def test_feeds_give_their_date_to_all(spark, kind):
    links = [item[0] for item in ITEMS]
    rows = entries(sm.read_sitemap(site(spark, feed(kind, links), f"application/{kind}+xml")))
    assert [(r[0], r[1]) for r in rows] == [(x, "2018-02-03T00:00:00.0+0000") for x in links if x.startswith("https://shop.test/")]


@pytest.mark.parametrize("kind", ["text", "atom", "rss", "index"])
def test_no_url_is_lost_and_a_cap_counts_accepted_ones(spark, kind):
    links = [f"https://shop.test/{i}" if i % 500 else "bad" for i in range(50_102)]
    whole = len([x for x in links if x != "bad"])
    if kind == "index":
        body = "<sitemapindex>" + "".join(f"<sitemap><loc>{x}</loc></sitemap>" for x in links) + "</sitemapindex>"
        assert sm.sitemap_index(site(spark, body)).count() == whole
        return
    body, of, url = ("\n".join(links), "text/plain", "https://shop.test/m.txt") if kind == "text" else (feed(kind, links), f"application/{kind}+xml", SITE)
    bodies = site(spark, body, of, url)
    assert sm.read_sitemap(bodies).count() == whole > 50_000
    capped = sm.read_sitemap(bodies, cap=700)
    assert capped.count() == 700 and capped.filter("url = 'bad'").isEmpty()


INDEX = f"<sitemapindex{NS}>" + "".join(f"<sitemap>{tagged('loc', item[0])}{tagged('lastmod', item[1])}</sitemap> " for item in ITEMS) + "</sitemapindex>"


def test_index(spark):
    rows = sm.sitemap_index(site(spark, INDEX)).select("url", format_iso(F.col("last_modified")).alias("m")).collect()
    read = {r[0]: r[1] for r in XML_ROWS}
    assert [tuple(r) for r in rows] == [(item[0], read.get(item[0])) for item in ITEMS if item[0].startswith("https:")]
    with pytest.raises(Exception, match="index format is not supported"):
        sm.read_sitemap(site(spark, INDEX)).collect()
    assert sm.read_sitemap(site(spark, INDEX), allow_index=True).count() == 0


@pytest.mark.parametrize(
    "text, content_type, url, message",
    [
        ("<unknown></unknown>", "text/xml", SITE, "unknown XML format"),
        (urlset(), "text/other", SITE + ".aaa", "unknown format"),
        ("no xml at all", "text/xml", SITE, "unknown XML format"),
        ("<urlset><url><loc>https://shop.test/</loc></url></wrong></urlset>", "text/xml", SITE, None),
    ],
)
def test_unusable_sitemaps_fail(spark, text, content_type, url, message):
    with pytest.raises(Exception, match=message):
        sm.read_sitemap(site(spark, text, content_type, url)).collect()


def test_format_checks_run_in_order(spark):
    df = spark.createDataFrame(
        [("http://a/m.xml", "text/plain"), ("http://a/m.txt", "text/xml"), ("http://a/m.gz", "text/plain"), ("http://a/m.gz?x=.xml", None), ("http://a/m", "application/octet-stream")],
        "u string, t string",
    )
    assert [r[0] for r in df.select(sm.body_kind(F.col("u"), F.col("t"))).collect()] == ["xml", "xml", "text", "gzip", "gzip"]


def test_website(spark):
    again = [("https://shop.test/p/0", None, None, "0.9"), ("https://shop.test/photo.JPG", None, None, None)]
    bodies = site(spark, urlset(items=[*ITEMS, *again]))
    docs = sm.website_documents(sm.read_sitemap(bodies))
    rows = {r.url: (r.id, r.last_modified, r.priority) for r in docs.collect()}
    assert rows["https://shop.test/p/0"] == ("https_shop_test_p_0", None, 0.9) and set(rows) == {r[0] for r in XML_ROWS}
    pages = spark.createDataFrame(
        [("https://shop.test/p/0", "<title>Zero</title>", "text/html; q"), ("https://shop.test/p/2", "GIF89", "image/gif"), ("https://shop.test/other", "<title>?</title>", "text/html")],
        "url string, html string, type string",
    )
    found, errors = website(bodies, pages, "MAIN", {"title": {"cssSelector": "title", "stripHtml": True}}, "type")
    assert [(r.url, r.detail.title, r.spaceKey) for r in found.collect()] == [("https://shop.test/p/0", "Zero", "MAIN")]
    assert {r.url for r in errors.collect()} == set(rows) - {"https://shop.test/p/0"}
