"""A paged source end to end: requests, pages, documents, a stored target."""

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F, types as T

from syncspark.config import SyncConfig
from syncspark.plans.store import SyncStore
from syncspark.plans.sync import sync_once, utc
from syncspark.sources.client import Page, fetch_pages
from syncspark.sources.payloads import extract_documents
from syncspark.sources.reads import update_slices

DOC = T.StructType().add("id", "string").add("updated", "string").add("title", "string")


def make_client(docs, size=2, with_total=True):
    """Built in a function, so that the class travels with the object."""
    make_page = Page

    class Client:
        def page(self, space_key, start_at, full, updated_after, updated_before):
            def hit(doc):
                when = datetime.fromisoformat(doc["updated"])
                low = updated_after and updated_after.replace(tzinfo=timezone.utc)
                high = updated_before and updated_before.replace(tzinfo=timezone.utc)
                return doc["space"] == space_key and (low is None or when >= low) and (high is None or when <= high)

            found = sorted(filter(hit, docs), key=lambda doc: doc["updated"])
            page = found[start_at : start_at + size]
            return make_page(json.dumps({"items": page}), len(page), len(found) if with_total else None)

    return Client()


DOCS = [
    {"id": f"{s}{i}", "space": s, "updated": f"2024-01-0{1 + i}T00:00:00+00:00", "title": f"t{i}"} for s in "AB" for i in range(5)
]


def pages(spark, client, **options):
    requests = spark.createDataFrame([("A", True), ("B", True), ("C", True)], "space_key string, full boolean")
    return fetch_pages(requests, client, **options)


def test_pages_until_the_total_or_an_empty_page(spark):
    def shape(df):
        return sorted((r.space_key, r.page_no, r.start_at) for r in df.collect())

    exact = [(s, n, 2 * n) for s in "AB" for n in range(3)] + [("C", 0, 0)]
    assert shape(pages(spark, make_client(DOCS))) == exact
    assert shape(pages(spark, make_client(DOCS, with_total=False))) == sorted(exact + [("A", 3, 5), ("B", 3, 5)])
    assert shape(pages(spark, make_client(DOCS, size=9), paged=False)) == [("A", 0, 0), ("B", 0, 0), ("C", 0, 0)]


def test_slices_read_everything(spark):
    spaces = spark.createDataFrame([("A",), ("B",)], "space_key string")
    slices = update_slices(spaces, utc(2024, 1, 1), utc(2024, 1, 6), timedelta(days=2)).withColumn("full", F.lit(False))
    docs = extract_documents(fetch_pages(slices, make_client(DOCS)), DOC, "items", carry=["space_key", "slice", "page_no"])
    assert {r.id for r in docs.collect()} == {d["id"] for d in DOCS}


def test_sync_from_a_client(spark, tmp_path):
    store = SyncStore(spark, str(tmp_path / "store"))
    cfg = SyncConfig(source="src", document_id="id", updated="updated", fields={"title": "title"}, full_update_period=timedelta(0))
    spaces = spark.createDataFrame([("src", "A"), ("src", "B")], "source string, space_key string")

    def reader(docs):
        def read(kinds):
            found = extract_documents(fetch_pages(kinds, make_client(docs)), DOC, "items")
            return found.withColumnRenamed("space_key", "spaceKey")

        return read

    first = sync_once(store, cfg, spaces, reader(DOCS), utc(2024, 2, 1)).runs
    assert {(r.space_key, r.full, r.documents_updated) for r in first.collect()} == {("A", True, 5), ("B", True, 5)}
    changed = [{**d, "title": "new", "updated": "2024-01-09T00:00:00+00:00"} if d["id"] == "A2" else d for d in DOCS]
    second = sync_once(store, cfg, spaces, reader(changed), utc(2024, 2, 2)).runs
    # The watermark is inclusive: the newest stored document is read again.
    assert {(r.space_key, r.full, r.documents_updated) for r in second.collect()} == {("A", False, 2), ("B", False, 1)}
    assert json.loads(store.current().filter("doc_id = 'A2'").first().body)["title"] == "new"
    assert store.current().count() == 10
