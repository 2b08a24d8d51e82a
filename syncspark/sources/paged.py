"""A remote system as a Python data source: requests are partitions, update times offsets.

``page_source(client)`` is a class to register; then

    spark.dataSource.register(page_source(client, "tracker"))
    spark.read.format("tracker").option("spaces", "A,B").load()

A request is one space, or one slice of update times of it, and each is a partition. Filters
on what is the same for a whole request (space, slice and its bounds) decide which requests
are made at all. As a stream, an offset is an update time, and a batch asks for what changed
between two of them.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, IsNull, LessThan, LessThanOrEqual, Not,
)

from syncspark.config import ReadMode, SyncConfig, parse_duration
from syncspark.session import prepare, ship_package
from syncspark.sources.client import PagedClient
from syncspark.sources.payloads import extract_documents

REQUEST_SCHEMA = (
    "space_key string, slice bigint, updated_after timestamp, updated_before timestamp, page_no bigint, start_at bigint, "
    "total bigint, payload string, error string"
)
_KINDS = {"string": pa.string(), "bigint": pa.int64(), "timestamp": pa.timestamp("us", "UTC")}
REQUEST_ARROW = pa.schema([(name, _KINDS[kind]) for name, kind in (column.split() for column in REQUEST_SCHEMA.split(", "))])
BATCH_CHARS = 1 << 20  # answers that are handed to Spark at once, beside the last one
PER_REQUEST = ("space_key", "slice", "updated_after", "updated_before")
SLICE_BITS = 32  # a page number of a slice, below the slice's number


@dataclass
class Request(InputPartition):
    """One space, or one slice of it."""

    space_key: str | None
    slice: int = 0
    full: bool = True
    updated_after: datetime | None = None
    updated_before: datetime | None = None


NOTHING = Request(None)  # a plan has one partition at least


def utc_time(value: str | datetime | None) -> datetime | None:
    """A point in time from an option or a row; one without a zone is in UTC."""
    if value is None or value == "":
        return None
    at = value if isinstance(value, datetime) else datetime.fromisoformat(value)
    return at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)


def sliced(space_key: str, full: bool, after: datetime | None, until: datetime | None, span: timedelta | None) -> list[Request]:
    """The requests that cover a space: one, or slices of ``span`` when both ends are known. Ends
    are inclusive, so a document on a border is read by both slices."""
    if span is None or after is None or until is None:
        return [Request(space_key, 0, full, after, until)]
    count = max(1, -(-(until - after) // span))
    return [Request(space_key, k, full, after + k * span, min(after + (k + 1) * span, until)) for k in range(count)]


_COMPARED = {
    EqualTo: lambda x, v: x == v,
    GreaterThan: lambda x, v: x > v,
    GreaterThanOrEqual: lambda x, v: x >= v,
    LessThan: lambda x, v: x < v,
    LessThanOrEqual: lambda x, v: x <= v,
    In: lambda x, v: x in v,
}


def holds(condition: Filter, request: Request) -> bool | None:
    """Whether a filter holds for all rows of a request, for SQL: None is unknown."""
    if isinstance(condition, Not):
        inner = holds(condition.child, request)
        return None if inner is None else not inner
    value = getattr(request, condition.attribute[0])
    if isinstance(condition, IsNull):
        return value is None
    if isinstance(condition, IsNotNull):
        return value is not None
    asked = getattr(condition, "value", None)
    if isinstance(value, datetime):
        asked = tuple(map(utc_time, asked)) if isinstance(asked, (tuple, list)) else utc_time(asked)
    if isinstance(condition, EqualNullSafe):
        return value == asked
    return None if value is None else _COMPARED[type(condition)](value, asked)


def _decidable(condition: Filter) -> bool:
    if isinstance(condition, Not):
        return _decidable(condition.child)
    return type(condition) in (*_COMPARED, EqualNullSafe, IsNull, IsNotNull) and len(condition.attribute) == 1 and condition.attribute[0] in PER_REQUEST


def _rows(client: PagedClient, request: Request, paged: bool, tolerant: bool) -> Iterator[tuple]:
    """Pages of a request until one is empty or the total is reached. When ``tolerant``, a request
    that breaks off ends with a row that says so."""
    start_at = page_no = 0
    asked = (request.space_key, request.slice, request.updated_after, request.updated_before)
    while True:
        try:
            page = client.page(request.space_key, start_at, request.full, request.updated_after, request.updated_before)
        except Exception as error:  # noqa: BLE001 - whatever the remote system answers
            if not tolerant:
                raise
            yield (*asked, page_no, start_at, None, None, f"{type(error).__name__}: {error}")
            return
        yield (*asked, page_no, start_at, page.total, page.payload, None)
        start_at, page_no = start_at + page.count, page_no + 1
        if not paged or page.count == 0 or (page.total is not None and page.total <= start_at):
            return


def batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of answers as they come, in batches of bounded text: left to itself, Spark counts
    rows only, and ten thousand answers are of any size."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[-2] or "")
        if chars >= BATCH_CHARS:
            yield _batch(held)
            held, chars = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), REQUEST_ARROW.types)], schema=REQUEST_ARROW)


def _flag(options: dict[str, str], name: str, default: bool) -> bool:
    return str(options.get(name, default)).lower() == "true"


def page_source(client: PagedClient, name: str) -> type[DataSource]:
    """A data source over ``client``, to be registered under ``name``.

    Options: ``requests``, a JSON list of objects with space_key, full and updated_after; or
    ``spaces``, a comma list, with ``after``. ``until`` ends the range of update times and
    ``span`` (5m, 1d) cuts it into slices. ``paged`` (true), ``tolerant`` (false). A stream
    reads ``spaces`` from ``after`` on, up to ``until`` or to the client's ``newest()``.
    """

    def asked(options: dict[str, str]) -> list[Request]:
        until, span = utc_time(options.get("until")), parse_duration(options.get("span"))
        if options.get("requests"):
            given = json.loads(options["requests"])
        else:
            given = [{"space_key": s.strip(), "updated_after": options.get("after")} for s in options.get("spaces", "").split(",") if s.strip()]
        found = []
        for r in given:
            after = utc_time(r.get("updated_after"))
            found += sliced(r["space_key"], bool(r.get("full", after is None)), after, until, span)
        return found

    class Reader(DataSourceReader):
        def __init__(self, options: dict[str, str]):
            self.options, self.filters = options, []

        def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
            for condition in filters:
                if _decidable(condition):
                    self.filters.append(condition)
                else:
                    yield condition

        def partitions(self) -> list[Request]:
            kept = [r for r in asked(self.options) if all(holds(f, r) for f in self.filters)]
            return kept or [NOTHING]

        def read(self, partition: Request) -> Iterator[pa.RecordBatch]:
            if partition.space_key is not None:
                yield from batches(_rows(client, partition, _flag(self.options, "paged", True), _flag(self.options, "tolerant", False)))

    class Stream(DataSourceStreamReader):
        def __init__(self, options: dict[str, str]):
            self.options = options

        def initialOffset(self) -> dict:
            return {"updated": self.options.get("after", "")}

        def latestOffset(self) -> dict:
            newest = self.options.get("until") or client.newest()
            return {"updated": utc_time(newest).isoformat()}

        def partitions(self, start: dict, end: dict) -> list[Request]:
            after, until = utc_time(start["updated"]), utc_time(end["updated"])
            spaces = [s.strip() for s in self.options.get("spaces", "").split(",") if s.strip()]
            return [r for s in spaces for r in sliced(s, after is None, after, until, parse_duration(self.options.get("span")))]

        def read(self, partition: Request) -> Iterator[pa.RecordBatch]:
            return batches(_rows(client, partition, _flag(self.options, "paged", True), _flag(self.options, "tolerant", False)))

    class PageSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return REQUEST_SCHEMA

        def reader(self, schema: T.StructType) -> Reader:
            return Reader(dict(self.options))

        def streamReader(self, schema: T.StructType) -> Stream:
            return Stream(dict(self.options))

    return PageSource


def page_documents(pages: DataFrame, schema: T.StructType, documents: str | None = None) -> DataFrame:
    """Documents of pages with spaceKey, page_no and pos, ordered by slice, page and place.

    A request that broke off gives a row without a document whose ``request_error`` says why.
    """
    fine = pages.filter("error is null").withColumn("page_no", (F.coalesce("slice", F.lit(0)) * F.lit(1 << SLICE_BITS) + F.col("page_no")).cast("bigint"))
    docs = extract_documents(fine, schema, documents).withColumnRenamed("space_key", "spaceKey").withColumn("request_error", F.lit(None).cast("string"))
    broken = pages.filter("error is not null").select(
        F.col("space_key").alias("spaceKey"),
        (F.coalesce("slice", F.lit(0)) * F.lit(1 << SLICE_BITS) + F.col("page_no")).cast("bigint").alias("page_no"),
        F.lit(-1).cast(docs.schema["pos"].dataType).alias("pos"),
        F.col("error").alias("request_error"),
    )
    return docs.unionByName(broken, allowMissingColumns=True)


def source_reader(
    spark: SparkSession, cfg: SyncConfig, name: str, schema: T.StructType, documents: str | None = None,
    now: datetime | None = None, tolerant: bool = True,
):
    """A reader for ``sync_once`` over a registered page source, in the configured read mode.

    ``simple`` makes one request a space, ``pagination`` goes on page by page,
    ``updateTimestamp`` asks from the stored update time on; with ``cfg.slice_span`` it asks
    slice by slice up to ``now``, from ``cfg.first_update`` on where nothing is stored.
    """
    ship_package(prepare(spark))

    def read(kinds: DataFrame) -> DataFrame:
        # One row a due space: as many as there are requests to plan.
        rows = kinds.select("space_key", "full", F.date_format(F.to_utc_timestamp("updated_after", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("updated_after")).collect()
        incremental = cfg.read_mode is ReadMode.UPDATE_TIMESTAMP
        first = cfg.first_update.isoformat() if cfg.first_update and cfg.slice_span else None
        asked = [{"space_key": r.space_key, "full": r.full, "updated_after": (r.updated_after or first) if incremental else None} for r in rows]
        pages = spark.read.format(name).option("requests", json.dumps(asked)).option("tolerant", str(tolerant)).option("paged", str(cfg.read_mode is not ReadMode.SIMPLE))
        if incremental and cfg.slice_span and now is not None:
            pages = pages.option("until", now.isoformat()).option("span", f"{int(cfg.slice_span / timedelta(milliseconds=1))}ms")
        return page_documents(pages.load(), schema, documents)

    return read
