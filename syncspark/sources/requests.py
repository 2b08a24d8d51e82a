"""Request URLs as columns of a plan table."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from syncspark.errors import ConfigError
from syncspark.functions.dates import MILLISECOND_EPOCH, format_datetime
from syncspark.functions.text import trim_to_null
from syncspark.functions.urls import valid_url


def _fill(url: Column, name: str, value: Column) -> Column:
    return F.replace(url, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))


def plan_requests(
    template: str, space_key: Column, updated_after: Column, updated_before: Column, start_at: Column,
    full: Column, api_key: str | None = None, date_format: str | None = None,
) -> Column:
    """URL of a list request; an absent value leaves its place empty."""
    fmt = date_format or MILLISECOND_EPOCH
    url = F.lit(template)
    url = _fill(url, "space", F.url_encode(space_key))
    url = _fill(url, "updatedAfter", F.url_encode(format_datetime(updated_after, fmt)))
    url = _fill(url, "updatedBefore", F.url_encode(format_datetime(updated_before, fmt)))
    url = _fill(url, "startAtIndex", start_at.cast("string"))
    url = _fill(url, "indexingType", F.when(full, "full").otherwise("inc"))
    return _fill(url, "apiKey", F.lit(api_key))


def plan_detail_urls(
    doc_id: Column, space_key: Column, template: str | None = None, url_field: Column | None = None
) -> Column:
    """URL of a document's details, from a template or from a field of the document.

    A missing or malformed URL in the field is null; the document is kept.
    """
    if template is not None and url_field is not None:
        raise ConfigError("give either a template or a field for detail URLs, not both")
    if url_field is not None:
        url = trim_to_null(url_field.cast("string"))
        return F.when(valid_url(url), url)
    if template is None:
        return F.lit(None).cast("string")
    url = _fill(F.lit(template), "space", F.url_encode(space_key))
    return _fill(url, "id", F.url_encode(doc_id))
