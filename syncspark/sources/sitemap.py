"""Sitemaps: XML, plain text, gzip, Atom and RSS bodies to rows of URLs.

Bodies come as rows of ``sitemap_url, content_type, body`` (text) and optionally
``content`` (bytes, for gzip). A body is one cell, bounded by the protocol at 10 MB;
its URLs are taken apart in place, so nothing is shuffled until de-duplication.

URL rows: ``sitemap_url, pos, url, last_modified, change_freq, priority, valid``.
"""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from syncspark.functions.dates import format_iso, sitemap_lastmod
from syncspark.functions.urls import (
    change_freq,
    ignored_extension,
    priority,
    sitemap_base,
    url_allowed,
    url_to_id,
    valid_url,
)
from syncspark.operators.changes import latest
from syncspark.session import ship_package

# Content types by format.
XML_TYPES = ["text/xml", "application/xml", "application/x-xml", "application/atom+xml", "application/rss+xml"]
TEXT_TYPES = ["text/plain"]
GZIP_TYPES = [
    "application/gzip", "application/x-gzip", "application/x-gunzip", "application/gzipped",
    "application/gzip-compressed", "application/x-compress", "gzip/document", "application/octet-stream",
]

_ENTRY = "struct<loc:string,lastmod:string,changefreq:string,priority:string>"


def _contains_any(text: Column, parts: list[str]) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | F.coalesce(F.contains(text, F.lit(part)), F.lit(False))
    return found


def body_kind(sitemap_url: Column, content_type: Column) -> Column:
    """``xml``, ``text`` or ``gzip``, looked for in that order; else the run fails."""
    path = F.regexp_replace(F.regexp_replace(sitemap_url, r"[?#].*\z", ""), r"^[A-Za-z]+://[^/]*", "")
    message = F.concat(F.lit("unknown format "), F.coalesce(content_type, F.lit("?")), F.lit(" at "), sitemap_url)
    return (
        F.when(F.endswith(path, F.lit(".xml")) | _contains_any(content_type, XML_TYPES), "xml")
        .when(F.endswith(path, F.lit(".txt")) | _contains_any(content_type, TEXT_TYPES), "text")
        .when(F.endswith(path, F.lit(".gz")) | _contains_any(content_type, GZIP_TYPES), "gzip")
        .otherwise(F.raise_error(message))
    )


def xml_kind(body: Column) -> Column:
    """Format of an XML body by the elements it has."""
    plain = F.regexp_replace(body, r"(?s)<!--.*?-->", "")

    def has(tag: str) -> Column:
        return plain.rlike(rf"<{tag}[\s>/]")

    unknown = F.raise_error(F.lit("unknown XML format of a sitemap"))
    return (
        F.when(has("sitemapindex"), "index")
        .when(has("urlset"), "urlset")
        .when(has("link") & has("feed"), "atom")
        .when(has("link") & has("rss"), "rss")
        .otherwise(unknown)
    )


def _from_xml(body: Column, schema: str) -> Column:
    text = F.regexp_replace(body, "^\ufeff", "")
    return F.from_xml(text, schema, {"mode": "FAILFAST", "ignoreSurroundingSpaces": "true"})


def _entries(items: Column, url, lastmod, freq=None, prio=None) -> Column:
    """Uniform entries out of a list of parsed elements."""

    def entry(item: Column) -> Column:
        none = F.lit(None).cast("string")
        return F.struct(
            F.trim(url(item)).alias("loc"),
            lastmod(item).alias("lastmod"),
            (freq(item) if freq else none).alias("changefreq"),
            (prio(item) if prio else none).alias("priority"),
        )

    return F.transform(items, entry)


URLSET = f"url array<{_ENTRY}>"
ATOM = "modified string, entry array<struct<link:array<struct<_href:string>>>>"
RSS = "channel struct<pubDate:string,item:array<struct<link:string>>>"
INDEX = "sitemap array<struct<_VALUE:string,loc:string,lastmod:string>>"


def _undated(item: Column) -> Column:
    return F.lit(None).cast("string")


def urlset_entries(doc: Column) -> Column:
    return _entries(doc["url"], lambda i: i["loc"], lambda i: i["lastmod"], lambda i: i["changefreq"], lambda i: i["priority"])


def atom_entries(doc: Column) -> Column:
    """Feed entries without a date: all get the feed's own."""
    return _entries(doc["entry"], lambda i: F.get(i["link"], F.lit(0))["_href"], _undated)


def rss_entries(doc: Column) -> Column:
    """Channel items without a date: all get the channel's own."""
    return _entries(doc["channel"]["item"], lambda i: i["link"], _undated)


def text_entries(body: Column) -> Column:
    """Non-empty lines."""
    lines = F.split(F.regexp_replace(body, "^\ufeff", ""), r"\r\n|\n|\r")
    return _entries(F.filter(lines, lambda line: line != ""), lambda i: i, _undated)


def index_entries(doc: Column) -> Column:
    """Child sitemaps of an index: address and date."""
    return _entries(doc["sitemap"], lambda i: F.coalesce(i["loc"], i["_VALUE"]), lambda i: i["lastmod"])


def url_rows(bodies: DataFrame, entries: Column, strict: bool = True, cap: int | None = None, date: Column | None = None) -> DataFrame:
    """Rows of the usable entries of each body.

    An entry with a bad URL is skipped; one outside the sitemap's directory is skipped
    when ``strict`` and marked otherwise. ``cap``, if given, is how many accepted entries
    of a body count. ``date`` is that of entries without their own; it is put on after
    they have become rows.
    """
    base = sitemap_base(F.col("sitemap_url"))

    def usable(entry: Column) -> Column:
        good = valid_url(entry["loc"])
        return good & url_allowed(base, entry["loc"]) if strict else good

    accepted = F.filter(entries, usable)
    if cap is not None:
        accepted = F.slice(accepted, 1, cap)
    date = F.lit(None).cast("string") if date is None else date
    rows = bodies.select("sitemap_url", date.alias("_date"), F.posexplode(accepted).alias("pos", "_e"))
    url = F.col("_e")["loc"]
    return rows.select(
        "sitemap_url",
        F.col("pos").cast("bigint").alias("pos"),
        url.alias("url"),
        sitemap_lastmod(F.coalesce(F.col("_e")["lastmod"], F.col("_date"))).alias("last_modified"),
        change_freq(F.col("_e")["changefreq"]).alias("change_freq"),
        priority(F.col("_e")["priority"]).alias("priority"),
        url_allowed(sitemap_base(F.col("sitemap_url")), url).alias("valid"),
    )


def _parsed(bodies: DataFrame, schema: str) -> DataFrame:
    """Bodies with ``_doc``: in a projection of its own, as expressions over a list would
    parse the body again for each element."""
    return bodies.select("sitemap_url", _from_xml(F.col("body"), schema).alias("_doc"))


def sitemap_xml(bodies: DataFrame, strict: bool = True) -> DataFrame:
    return url_rows(_parsed(bodies, URLSET), urlset_entries(F.col("_doc")), strict)


def sitemap_text(bodies: DataFrame, strict: bool = True, cap: int | None = None) -> DataFrame:
    return url_rows(bodies, text_entries(F.col("body")), strict, cap)


def sitemap_atom(bodies: DataFrame, strict: bool = True) -> DataFrame:
    doc = F.col("_doc")
    return url_rows(_parsed(bodies, ATOM), atom_entries(doc), strict, date=doc["modified"])


def sitemap_rss(bodies: DataFrame, strict: bool = True) -> DataFrame:
    doc = F.col("_doc")
    return url_rows(_parsed(bodies, RSS), rss_entries(doc), strict, date=doc["channel"]["pubDate"])


def sitemap_index(bodies: DataFrame) -> DataFrame:
    """Child sitemaps: ``sitemap_url, pos, url, last_modified``; bad addresses are skipped."""
    good = F.filter(index_entries(F.col("_doc")), lambda e: valid_url(e["loc"]))
    rows = _parsed(bodies, INDEX).select("sitemap_url", F.posexplode(good).alias("pos", "_e"))
    return rows.select(
        "sitemap_url",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("_e")["loc"].alias("url"),
        sitemap_lastmod(F.col("_e")["lastmod"]).alias("last_modified"),
    )


def _gunzip(batch: pd.Series) -> pd.Series:
    return batch.map(lambda data: None if data is None else gzip.decompress(data).decode("utf-8", "replace"))


def gunzip(content: Column) -> Column:
    """Text of gzip bytes. Files with the usual suffix need no such step: Spark's text
    source decompresses them while reading."""
    ship_package(SparkSession.active())
    return F.pandas_udf(_gunzip, "string")(content)


def read_gzip_files(spark, path: str) -> DataFrame:
    """Gzip sitemap files as bodies."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("sitemap_url"),
        F.lit("application/gzip").alias("content_type"),
        F.col("value").alias("body"),
    )


def unzipped(bodies: DataFrame) -> DataFrame:
    """Bodies with gzip content turned into text; other rows never meet Python."""
    kind = body_kind(F.col("sitemap_url"), F.col("content_type"))
    if "content" not in bodies.columns:
        return bodies.withColumn("_kind", F.when(kind == "gzip", "xml").otherwise(kind))
    tagged = bodies.withColumn("_kind", kind)
    plain = tagged.filter("_kind <> 'gzip'").drop("content")
    packed = (
        tagged.filter("_kind = 'gzip'").withColumn("body", gunzip(F.col("content")))
        .withColumn("_kind", F.lit("xml")).drop("content")
    )
    return plain.unionByName(packed)


def read_sitemap(bodies: DataFrame, strict: bool = True, allow_index: bool = False, cap: int | None = None) -> DataFrame:
    """URLs of bodies in any supported format.

    Every body is parsed once, by the branch of its format. An index is refused unless
    ``allow_index``, as it names sitemaps and not documents. ``cap``, if given, is how many
    accepted URLs of a body that is no XML sitemap count; by default all do.
    """
    tagged = unzipped(bodies)
    body = F.col("body")
    kinds = tagged.withColumn("_format", F.when(F.col("_kind") == "xml", xml_kind(body)).otherwise("text"))
    kind = F.col("_format")
    refused = F.raise_error(F.lit("sitemap index format is not supported here"))
    parsed = kinds.select(
        "sitemap_url", "_format", "body",
        *[F.when(kind == name, _from_xml(body, schema)).alias(f"_{name}") for name, schema in (("urlset", URLSET), ("atom", ATOM), ("rss", RSS))],
    )
    entries = (
        F.when(kind == "urlset", urlset_entries(F.col("_urlset")))
        .when(kind == "text", text_entries(body))
        .when(kind == "atom", atom_entries(F.col("_atom")))
        .when(kind == "rss", rss_entries(F.col("_rss")))
        .when(kind == "index", F.slice(text_entries(F.lit("-")), 1, 0) if allow_index else refused)
    )
    date = F.coalesce(F.col("_atom")["modified"], F.col("_rss")["channel"]["pubDate"])
    if cap is not None:
        base = sitemap_base(F.col("sitemap_url"))
        usable = F.filter(entries, lambda e: valid_url(e["loc"]) & url_allowed(base, e["loc"]) if strict else valid_url(e["loc"]))
        entries = F.when(kind == "urlset", entries).otherwise(F.slice(usable, 1, cap))
    return url_rows(parsed, entries, strict, date=date)


def website_documents(urls: DataFrame) -> DataFrame:
    """One document per URL: ``id, url, last_modified, priority``.

    Entries with an ignored extension are left out; the last of equal URLs within a
    sitemap wins.
    """
    kept = urls.filter(~ignored_extension(F.col("url")))
    newest = latest(kept.select("sitemap_url", "url", "pos", "last_modified", "priority"), ["sitemap_url", "url"], ["pos"])
    return newest.select(
        url_to_id(F.col("url")).alias("id"),
        "url",
        format_iso(F.col("last_modified")).alias("last_modified"),
        "priority",
    )
