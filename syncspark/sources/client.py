"""Remote systems that hand out documents page by page.

A system is reached through a client object; Spark distributes the requests. The
requests are rows, so a large space is read by many tasks when it is cut into update
slices (``reads.update_slices``), and nothing of the answers passes the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from typing import NamedTuple, Protocol

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from syncspark.session import ship_package


class Page(NamedTuple):
    """One answer: its text, how many documents it holds, and the total when known."""

    payload: str
    count: int
    total: int | None = None


class PagedClient(Protocol):
    """What a remote system offers. Objects are sent to the tasks, so they are picklable
    and open their connections there."""

    def page(
        self, space_key: str, start_at: int, full: bool, updated_after: datetime | None, updated_before: datetime | None
    ) -> Page: ...


MOST_TASKS = 10_000

PAYLOAD_SCHEMA = "space_key string, slice bigint, page_no bigint, start_at bigint, total bigint, payload string"


def fetch_pages(requests: DataFrame, client: PagedClient, paged: bool = True) -> DataFrame:
    """Payload rows for every request.

    ``requests``: space_key, full, and optionally slice, updated_after, updated_before.
    A request goes on to the next page until a page is empty or the total is reached;
    without ``paged`` one answer is all there is. Each request is its own unit of work,
    so requests are spread over the cluster first.
    """
    ship_package(requests.sparkSession)
    defaults = {"slice": "bigint", "updated_after": "timestamp", "updated_before": "timestamp"}
    given = [F.col(n) if n in requests.columns else F.lit(None).cast(kind).alias(n) for n, kind in defaults.items()]
    rows = requests.select("space_key", "full", *given)
    # With a number, or Spark would join such small partitions to one task again.
    rows = rows.repartition(max(1, min(rows.count(), MOST_TASKS)), "space_key", "slice")

    def moment(value) -> datetime | None:
        return None if pd.isna(value) else value.to_pydatetime()

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                start_at = page_no = 0
                while True:
                    page = client.page(r.space_key, start_at, bool(r.full), moment(r.updated_after), moment(r.updated_before))
                    number = None if pd.isna(r.slice) else int(r.slice)
                    yield pd.DataFrame(
                        [(r.space_key, number, page_no, start_at, page.total, page.payload)],
                        columns=["space_key", "slice", "page_no", "start_at", "total", "payload"],
                    ).astype({"slice": "Int64", "total": "Int64"})
                    start_at, page_no = start_at + page.count, page_no + 1
                    if not paged or page.count == 0 or (page.total is not None and page.total <= start_at):
                        break

    return rows.mapInPandas(fetch, PAYLOAD_SCHEMA)
