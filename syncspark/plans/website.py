"""Website mode: sitemap to pages to mapped documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from syncspark.operators.joins import keyed_join
from syncspark.sources.details import SKIPPED
from syncspark.sources.html import html_extract
from syncspark.sources.sitemap import read_sitemap, website_documents


def website(
    sitemaps: DataFrame, pages: DataFrame, space_key: str, mapping: dict | None = None, content_type: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Documents of a website with their ``detail``, and the errors of missing pages.

    ``pages``: url, html and optionally the column named by ``content_type``, one row
    per URL. A page no sitemap names is not parsed, and pages meet the much smaller
    document rows in place unless those outgrow a broadcast.
    """
    docs = website_documents(read_sitemap(sitemaps))
    kind = F.col(content_type) if content_type else None
    detailed = html_extract(keyed_join(pages, docs, ["url"], "inner"), mapping, content_type=kind)
    found = detailed.filter("status = 200").select(
        "id", "url", "last_modified", "priority", "detail", F.lit(space_key).alias("spaceKey")
    )
    is_html = F.lit(True) if kind is None else F.contains(kind, F.lit("text/html"))
    errors = keyed_join(docs, pages.filter(is_html).select("url"), ["url"], "left_anti").select(
        "id", "url", F.lit(SKIPPED).alias("message")
    )
    return found, errors
