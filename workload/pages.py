"""H1-H9 and S21: fields out of web pages. The pages hold one title, h1 and ad each."""

from __future__ import annotations

from pyspark.sql import functions as F

from syncspark.sources.html import HtmlField, html_extract
from syncspark.plans.website import website
from workload.base import query, table
from workload.sources import DOC_ID_SQL, listed_pages, xml_bodies


def clean(expr: str) -> str:
    """DuckDB: text of an HTML fragment by the text rule."""
    pieces = (
        f"string_split(regexp_replace(regexp_replace({expr}, '(?s)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', chr(1), 'g'), "
        "'<[^>]*>', chr(1), 'g'), chr(1))"
    )
    plain = "lambda x: trim(regexp_replace(" + unescape("x") + r", '[ \t\n\f\r]+', ' ', 'g'))"
    return f"array_to_string(list_filter(list_transform({pieces}, {plain}), lambda x: x <> ''), ' ')"


def unescape(expr: str) -> str:
    """DuckDB: decoded references; the last one of a text may lack its semicolon."""
    for name, char in (("nbsp", " "), ("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        expr = f"replace(regexp_replace({expr}, '&{name}$', '&{name};'), '&{name};', '{char}')"
    return expr


def part(tag: str, attrs: str = "") -> str:
    return f"regexp_extract(html, '(?s)<{tag}{attrs}[^>]*>(.*?)</{tag}>', 1)"


HREFS = "regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>'), '<a href=\"([^\"]*)\"', 1)"
ITEMS = "regexp_extract_all(html, '(?s)<li>.*?</li>')"


def extract(spark, d, mapping, **options):
    return html_extract(table(spark, d, "pages"), mapping, **options)


@query("""
SELECT page_id, CASE WHEN page_id % 4 = 3 THEN 404 ELSE 200 END AS status, page_id % 4 <> 3 AS has_detail FROM pages
""")
def h1_only_html(spark, d):
    pages = table(spark, d, "pages").withColumn(
        "type", F.when(F.col("page_id") % 4 == 3, "application/pdf").otherwise("text/html; charset=utf-8")
    )
    out = html_extract(pages, {"title": {"cssSelector": "title", "stripHtml": True}}, content_type=F.col("type"))
    return out.select("page_id", "status", F.col("detail.title").isNotNull().alias("has_detail"))


@query("SELECT page_id, html AS detail FROM pages")
def h2_whole_page(spark, d):
    return extract(spark, d, None).select("page_id", "detail")


@query(f"""
SELECT page_id, {clean(part('title'))} AS title, CAST(NULL AS VARCHAR) AS absent, CAST(NULL AS VARCHAR) AS absent_text FROM pages
""")
def h3_mapping(spark, d):
    mapping = {
        "title": {"cssSelector": "head title", "stripHtml": "true"},
        "absent": {"cssSelector": ".nothing"},
        "absent_text": {"cssSelector": "#nothing", "stripHtml": True},
    }
    return extract(spark, d, mapping).select("page_id", "detail.title", "detail.absent", "detail.absent_text")


@query(f"""
SELECT page_id, {unescape(f"array_to_string(list_transform({HREFS}, lambda x: trim(x)), ' ')")} AS links,
       CAST(NULL AS VARCHAR) AS nothing, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang
FROM pages
""")
def h4_attribute_values(spark, d):
    mapping = {
        "links": HtmlField("nav a", value_attribute="href"),
        "nothing": HtmlField("nav a", value_attribute="title"),
        "lang": HtmlField("html", value_attribute="lang"),
    }
    return extract(spark, d, mapping).select("page_id", "detail.*")


@query(f"""
SELECT page_id, {clean(part('div', ' class="ad"'))} AS ad, {clean(f"array_to_string({ITEMS}, ' ')")} AS items FROM pages
""")
def h5_stripped_text(spark, d):
    mapping = {"ad": HtmlField("div.ad", True), "items": HtmlField("nav li", True)}
    return extract(spark, d, mapping).select("page_id", "detail.*")


@query(f"SELECT page_id, {part('h1')} AS one, array_to_string({ITEMS}, chr(10)) AS several FROM pages")
def h6_inner_or_outer_html(spark, d):
    mapping = {"one": HtmlField("article h1"), "several": HtmlField("li")}
    return extract(spark, d, mapping).select("page_id", "detail.*")


@query(f"SELECT page_id, {clean('html')} AS all_text, html AS all_html FROM pages")
def h7_no_selector(spark, d):
    mapping = {"all_text": HtmlField(strip_html=True), "all_html": HtmlField()}
    return extract(spark, d, mapping).select("page_id", "detail.*")


@query(f"SELECT page_id, {clean(part('article'))} AS article, {clean(part('footer'))} AS footer FROM pages")
def h8_text_rule(spark, d):
    mapping = {"article": HtmlField("article", True), "footer": HtmlField("footer", True)}
    return extract(spark, d, mapping).select("page_id", "detail.*")


@query(f"""
SELECT page_id, {clean(part('div', ' class="ad"'))} AS by_class, {clean(f"({ITEMS})[2]")} AS second,
       {unescape(f"trim(({HREFS})[1])")} AS first_link, {clean(part('div', ' class="ad"'))} AS by_value, {clean(part('h1'))} AS nested
FROM pages
""")
def h9_selectors(spark, d):
    mapping = {
        "by_class": HtmlField(".ad", True),
        "second": HtmlField("nav li:eq(1)", True),
        "first_link": HtmlField("nav li:eq(0) > a[href]", value_attribute="href"),
        "by_value": HtmlField("body div[class=ad]", True),
        "nested": HtmlField("body article h1", True),
    }
    return extract(spark, d, mapping).select("page_id", "detail.*")


@query(f"""
WITH p AS (SELECT *, 'http://site.org/' || page_id || '/' || regexp_replace(url, '^https?://', '') AS u FROM pages)
SELECT {DOC_ID_SQL} AS id, u AS url, {clean(part('title'))} AS title,
       CASE WHEN page_id % 20 <= 10 THEN page_id % 20 / CAST(10 AS DOUBLE) ELSE 0.5 END AS priority, 'MAIN' AS space_key
FROM p WHERE page_id % 10 < 8
""")
def s21_html_extract(spark, d):
    pages = listed_pages(spark, d).select("page_id", "url").join(table(spark, d, "pages").select("page_id", "html"), "page_id")
    docs, _ = website(xml_bodies(spark, d), pages, "MAIN", {"title": {"cssSelector": "title", "stripHtml": True}})
    return docs.select("id", "url", F.col("detail.title").alias("title"), "priority", F.col("spaceKey").alias("space_key"))
