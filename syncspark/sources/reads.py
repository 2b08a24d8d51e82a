"""The read modes: simple, pagination, update time, and bounded slices."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from syncspark.operators.joins import keyed_join


def in_type_of(df: DataFrame, column: str, at: datetime) -> Column:
    """A bound, in UTC, of the column's own type, so that a comparison reaches the scan."""
    kind = df.schema[column].dataType
    if at.tzinfo is not None:
        at = at.astimezone(timezone.utc).replace(tzinfo=None)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.lit(at.isoformat(sep=" ")).cast(kind)
    raise TypeError(f"column {column} is no point in time but {kind.simpleString()}")


def scan_simple(docs: DataFrame, space_key: str | None = None, column: str = "space_key") -> DataFrame:
    """All documents of a space, or of every space in one plan."""
    return docs if space_key is None else docs.filter(F.col(column) == space_key)


def scan_updated(docs: DataFrame, updated: str, after: datetime | None, space_key: str | None = None) -> DataFrame:
    """Documents updated at or after the watermark; without one, the whole history."""
    found = scan_simple(docs, space_key)
    return found if after is None else found.filter(F.col(updated) >= in_type_of(docs, updated, after))


def scan_updated_per_space(docs: DataFrame, updated: str, watermarks: DataFrame) -> DataFrame:
    """The same for many spaces at once.

    ``watermarks``: space_key, updated_after, one row per space, null for a full read.
    """
    # The oldest bound of all is a literal, and so reaches the files; spaces that are read
    # whole are a scan of their own, lest that bound is lost.
    oldest, whole = watermarks.agg(F.min("updated_after"), F.count_if(F.col("updated_after").isNull())).first()
    marks, scans = watermarks.select("space_key", F.col("updated_after").alias("_after")), []
    if oldest is not None:
        kind = docs.schema[updated].dataType
        bound = watermarks.sparkSession.range(1).select(F.lit(oldest).cast(kind).cast("string")).first()[0]
        since = docs.filter(F.col(updated) >= F.lit(bound).cast(kind))
        joined = keyed_join(since, marks.filter("_after is not null"), ["space_key"], "inner", hot=True)
        scans.append(joined.filter(F.col(updated) >= F.col("_after")).drop("_after"))
    if whole:
        scans.append(keyed_join(docs, marks.filter("_after is null").select("space_key"), ["space_key"], "left_semi", hot=True))
    return reduce(DataFrame.unionByName, scans) if scans else docs.limit(0)


def scan_updated_slice(
    docs: DataFrame, updated: str, after: datetime | None, span: timedelta, initial: datetime | None = None
) -> DataFrame:
    """One bounded read, both ends inclusive; ``initial`` stands in for a missing watermark."""
    start = after if after is not None else initial
    if start is None:
        return docs
    low, high = in_type_of(docs, updated, start), in_type_of(docs, updated, start + span)
    return docs.filter(F.col(updated).between(low, high))


def update_slices(spaces: DataFrame, start: datetime, end: datetime, span: timedelta) -> DataFrame:
    """Consecutive slices that cover a time range, for every space."""
    count = max(1, -(-(end - start) // span))
    steps = F.explode(F.sequence(F.lit(0), F.lit(int(count) - 1)))
    step = F.make_dt_interval(secs=F.lit(span.total_seconds()).cast("decimal(18,6)"))
    return spaces.select("space_key", steps.alias("slice")).select(
        "space_key",
        "slice",
        (F.lit(start) + step * F.col("slice")).alias("updated_after"),
        (F.lit(start) + step * (F.col("slice") + 1)).alias("updated_before"),
    )


def assign_slice(updated: Column, start: datetime, span: timedelta) -> Column:
    """Number of the slice that reads a document: an equality instead of a range join.

    A document on a boundary belongs to both inclusive reads; the later slice is the
    one whose write stays.
    """
    micros = int(span / timedelta(microseconds=1))
    offset = F.unix_micros(updated.cast("timestamp")) - F.unix_micros(F.lit(start))
    return F.floor(offset / F.lit(micros)).cast("bigint")


def scan_pages(pages: DataFrame, documents: str = "documents") -> DataFrame:
    """Documents of every page up to the stop page of its space.

    ``pages``: space_key, page_no, start_at, total, documents. A space stops at its
    first empty page or where the total is reached. The stop pages come from an
    aggregate over the page headers alone, so documents are not shuffled.
    """
    count = F.size(documents)
    stop = (count == 0) | F.coalesce(F.col("total") <= F.col("start_at") + count, F.lit(False))
    last = pages.groupBy("space_key").agg(F.min(F.when(stop, F.col("page_no"))).alias("_last"))
    reached = keyed_join(pages, last, ["space_key"], "left", hot=True).filter(
        F.col("_last").isNull() | (F.col("page_no") <= F.col("_last"))
    )
    return reached.select("space_key", "page_no", F.posexplode(documents).alias("pos", "document"))
