"""URL rules used by the website sources."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from syncspark.functions.text import strip_blanks

# Characters of a URL that an id must not contain.
ID_UNSAFE = ":.=\\/?&%*$#@+<>"
# Extensions of sitemap entries that are never documents.
IGNORED_EXTENSIONS = [
    "txt", "jpg", "jpeg", "tiff", "gif", "json", "otf", "eot",
    "svg", "ttf", "woff", "gz", "zip", "exe", "rar",
]
# Change frequencies in the order they are looked for.
CHANGE_FREQUENCIES = ["ALWAYS", "HOURLY", "DAILY", "WEEKLY", "MONTHLY", "YEARLY", "NEVER"]
DEFAULT_PRIORITY = 0.5

_KNOWN_SCHEME = r"(?i)^(url:)?(https?|ftp|file|mailto):"
_PORT = r"^[A-Za-z]+://(?:[^/?#]*@)?[^/?#:@\[]*:([^/?#]*)"


def file_extension(url: Column) -> Column:
    """Lower-case text after the last dot of the last path step, or null."""
    return F.nullif(F.lower(F.regexp_extract(strip_blanks(url), r"(?s)^.+\.([^./]+)\z", 1)), F.lit(""))


def url_to_id(url: Column) -> Column:
    return F.translate(F.replace(url, F.lit("://"), F.lit("_")), ID_UNSAFE, "_" * len(ID_UNSAFE))


def sitemap_base(url: Column) -> Column:
    """Directory of a sitemap, lower-cased."""
    return F.regexp_replace(F.lower(url), r"/[^/]*\z", "/")


def url_allowed(base: Column, url: Column) -> Column:
    return F.coalesce(F.startswith(F.lower(url), F.lower(base)), F.lit(False))


def valid_url(url: Column) -> Column:
    """True for a known scheme and, when given, a numeric port."""
    trimmed = strip_blanks(url)
    known = trimmed.rlike(_KNOWN_SCHEME) & F.regexp_extract(trimmed, _PORT, 1).rlike(r"^[0-9]*\z")
    return F.coalesce(known, F.lit(False))


def priority(value: Column) -> Column:
    number = value.try_cast("double")
    return F.when(number.between(0.0, 1.0), number).otherwise(F.lit(DEFAULT_PRIORITY))


def change_freq(value: Column) -> Column:
    upper = F.upper(value)
    return F.coalesce(*[F.when(F.contains(upper, F.lit(name)), F.lit(name)) for name in CHANGE_FREQUENCIES])


def ignored_extension(url: Column) -> Column:
    return F.coalesce(file_extension(url).isin(*IGNORED_EXTENSIONS), F.lit(False))
