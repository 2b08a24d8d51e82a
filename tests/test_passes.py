"""Whole runs over a stored target: three kinds of changes, three comment modes."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from syncspark.config import SyncConfig
from syncspark.operators import state as st
from syncspark.plans.manage import force_run, pause_source, resume_source, source_report
from syncspark.plans.store import SyncStore
from syncspark.plans.sync import sync_once, utc
from syncspark.sources.details import mark_skipped

SCHEMA = (
    "key string, spaceKey string, page_no int, pos int, fields struct<updated:string, deleted:string, title:string, "
    "talk:array<struct<id:string,body:string>>>"
)
T0 = utc(2024, 5, 1)


def doc(key, updated, comments=(), deleted=None, title="t", space="AB", page=0, pos=0):
    talk = [{"id": c, "body": f"{key} {c} {updated}"} for c in comments]
    fields = {"updated": f"2012-09-06T{updated}.000-0400", "deleted": deleted, "title": title, "talk": talk}
    return {"key": key, "spaceKey": space, "page_no": page, "pos": pos, "fields": fields}


def config(mode):
    return SyncConfig(
        source="src", document_id="key", updated="fields.updated", deleted="fields.deleted", deleted_value="true",
        fields={"title": "fields.title"}, comment_mode=mode, comments="fields.talk", comment_id="id",
        comment_type="comment", field_comments="comments", comment_fields={"body": "body"},
        full_update_period=timedelta(0),
    )


@pytest.fixture
def store(spark, tmp_path):
    return SyncStore(spark, str(tmp_path / "store"))


class Sync:
    def __init__(self, store, mode):
        self.store, self.cfg, self.now = store, config(mode), T0
        self.spaces = store.spark.createDataFrame([("src", "AB"), ("src", "ZZ")], "source string, space_key string")
        self.asked = {}

    def run(self, docs, space="AB", full=False):
        spark = self.store.spark
        self.now += timedelta(hours=1)
        spaces = self.spaces.filter(F.col("space_key") == space)
        if full:
            force_run(self.store, "src", spaces, st.FORCE_FULL, self.now)
        frame = spark.createDataFrame([json.dumps(d) for d in docs], "string").select(
            F.from_json("value", SCHEMA).alias("d")
        ).select("d.*").filter(F.col("spaceKey") == space)

        def read(kinds):
            self.asked = {r.space_key: (r.full, r.updated_after) for r in kinds.collect()}
            return frame

        report = sync_once(self.store, self.cfg, spaces, read, self.now)
        row = report.runs.first()
        assert row.ok, row.error_message
        return row.documents_updated, row.documents_deleted, row.comments_deleted

    def keys(self):
        return {(r.doc_type, r.doc_id) for r in self.store.current().collect()}

    def watermark(self, space="AB"):
        marks = st.state_get(self.store.state("src"), st.WATERMARK).filter(F.col("space_key") == space)
        row = marks.select(F.date_format("watermark", "HH:mm:ss").alias("t")).first()
        return row.t if row else None


FIRST = [
    doc("D-1", "02:26:53", ["c11", "c12"], pos=0),
    doc("D-2", "02:52:05", ["c21"], pos=1),
    doc("D-3", "03:27:25", ["c31"], pos=2),
]
D1_NEW = doc("D-1", "03:28:21", ["c11", "c13"], title="new")
D2_GONE = doc("D-2", "06:52:05", deleted="true")


def test_incremental_embedded(store):
    sync = Sync(store, "embedded")
    assert sync.run(FIRST) == (3, 0, 0)
    assert sync.asked == {"AB": (True, None)}
    assert sync.watermark() == "07:27:25"
    assert sync.run([D1_NEW]) == (1, 0, 0)
    assert sync.asked["AB"][0] is False
    assert sync.watermark() == "07:28:21"
    body = json.loads(store.current().filter("doc_id = 'D-1'").first().body)
    assert body["title"] == "new" and [c["body"] for c in body["comments"]] == ["D-1 c11 03:28:21", "D-1 c13 03:28:21"]
    assert sync.run([D2_GONE]) == (0, 1, 0)
    assert sync.keys() == {("document", "D-1"), ("document", "D-3")}
    assert sync.watermark() == "10:52:05"


def test_incremental_child_keeps_vanished_comments(store):
    sync = Sync(store, "child")
    assert sync.run(FIRST) == (3, 0, 0)
    assert sync.run([D1_NEW]) == (1, 0, 0)
    assert {k for t, k in sync.keys() if t == "comment"} == {"c11", "c12", "c13", "c21", "c31"}
    assert sync.run([D2_GONE]) == (0, 1, 1)
    assert {k for t, k in sync.keys() if t == "comment"} == {"c11", "c12", "c13", "c31"}


@pytest.mark.parametrize("mode, expected", [("embedded", (1, 2, 0)), ("child", (1, 2, 3)), ("standalone", (1, 2, 3))])
def test_full_run_removes_flagged_and_vanished(store, mode, expected):
    sync = Sync(store, mode)
    others = set()
    if mode == "child":
        others = {("document", "Z-1")}
        sync.run([doc("Z-1", "02:26:53", space="ZZ")], space="ZZ")
    sync.run(FIRST)
    sync.run([D1_NEW])
    page = [{**D2_GONE, "pos": 0}, {**D1_NEW, "pos": 1}]
    assert sync.run(page, full=True) == expected
    comments = set() if mode == "embedded" else {("comment", "c11"), ("comment", "c13")}
    assert sync.keys() == {("document", "D-1")} | comments | others
    # The last document in page order counts, not the newest one.
    assert sync.watermark() == "07:28:21"


def test_rereading_the_last_document_bumps_the_watermark(store):
    sync = Sync(store, "none")
    sync.run(FIRST)
    assert sync.run([FIRST[2]]) == (1, 0, 0)
    assert sync.watermark() == "07:27:26"


def test_document_that_moves_to_another_space(store):
    sync = Sync(store, "none")
    sync.run([doc("D-1", "02:00:00"), doc("D-2", "02:00:01", pos=1)])
    sync.run([doc("D-1", "03:00:00", space="ZZ")], space="ZZ")
    assert {(r.doc_id, r.space_key) for r in store.current().collect()} == {("D-1", "ZZ"), ("D-2", "AB")}


def test_failed_run_changes_no_rows(store):
    sync = Sync(store, "none")
    sync.run(FIRST)
    before = sync.keys()
    for bad, message in (
        ({**doc("D-9", "04:00:00"), "key": " "}, "document id not found"),
        ({**doc("D-9", "04:00:00"), "fields": {"title": "x"}}, "last update time not found"),
    ):
        with pytest.raises(AssertionError, match=message):
            sync.run([doc("D-8", "05:00:00"), bad])
        assert sync.keys() == before and sync.watermark() == "07:27:25"
    last = store.activity().orderBy(F.desc("start_date")).first()
    assert last.result == "ERROR" and "last update time" in last.error_message
    # Without a full period a failed full run is forced again.
    with pytest.raises(AssertionError):
        sync.run([{**FIRST[0], "key": None}], full=True)
    sync.run(FIRST)
    assert sync.asked["AB"][0] is True


def test_a_bad_document_fails_only_its_space(store):
    sync = Sync(store, "child")
    good, bad = doc("D-1", "02:00:00", ["c1"]), doc("Z-1", "02:00:00", [None], space="ZZ")
    frame = store.spark.createDataFrame([json.dumps(d) for d in (good, bad)], "string").select(
        F.from_json("value", SCHEMA).alias("d")
    ).select("d.*")
    report = sync_once(store, sync.cfg, sync.spaces, lambda kinds: frame, T0)
    rows = {r.space_key: (r.ok, r.documents_updated, r.error_message) for r in report.runs.collect()}
    assert rows == {"AB": (True, 1, None), "ZZ": (False, 0, "comment id not found in data of document Z-1")}
    assert sync.keys() == {("document", "D-1"), ("comment", "c1")}
    assert sync.watermark("AB") == "06:00:00" and sync.watermark("ZZ") is None


def test_broken_reader_fails_the_pass(store):
    sync = Sync(store, "none")

    def broken(kinds):
        raise OSError("no answer")

    report = sync_once(store, sync.cfg, sync.spaces, broken, T0)
    assert {(r.ok, r.error_message) for r in report.runs.collect()} == {(False, "no answer")}
    assert sync.keys() == set()


def test_unreachable_details_are_counted_and_removed_by_a_full_run(store):
    sync = Sync(store, "none")
    sync.run(FIRST)
    frame = store.spark.createDataFrame([json.dumps(d) for d in FIRST], "string").select(
        F.from_json("value", SCHEMA).alias("d")
    ).select("d.*")
    details = store.spark.createDataFrame(
        [("D-1", 200, "x"), ("D-2", 404, None)], "key string, status int, detail string"
    )
    spaces = sync.spaces.filter("space_key = 'AB'")
    force_run(store, "src", spaces, st.FORCE_FULL, sync.now)
    report = sync_once(store, sync.cfg, spaces, lambda kinds: mark_skipped(frame, details, ["key"]), sync.now + timedelta(hours=1))
    row = report.runs.first()
    assert (row.ok, row.documents_updated, row.documents_deleted, row.documents_with_error) == (True, 2, 1, 1)
    assert "document skipped" in row.error_message
    assert sync.keys() == {("document", "D-1"), ("document", "D-3")}


def test_management(store):
    sync = Sync(store, "none")
    sync.run(FIRST)
    assert force_run(store, "src", sync.spaces, st.FORCE_FULL, sync.now, "nope").count() == 0
    assert force_run(store, "src", sync.spaces, st.FORCE_INCREMENTAL, sync.now, "AB").count() == 1
    due = st.spaces_due(sync.spaces, store.state("src"), sync.now, timedelta(days=9), timedelta(0))
    assert {r.space_key for r in due.collect()} == {"AB", "ZZ"}
    pause_source(store, "src", sync.now)
    assert st.spaces_due(sync.spaces, store.state("src"), sync.now, timedelta(days=9), timedelta(0)).isEmpty()
    assert sync_once(store, sync.cfg, sync.spaces, lambda k: None, sync.now) is None
    report = {(r.section, r.space_key): json.loads(r.report) for r in source_report(store, "src", sync.spaces, sync.now, T0).collect()}
    assert report["source", None]["state"] == "stopped" and "stopped_permanently" in report["source", None]
    assert report["indexed_spaces", "ZZ"] == {"space_key": "ZZ"}
    last = report["indexed_spaces", "AB"]["last_indexing"]
    assert (last["update_type"], last["documents_updated"], last["result"]) == ("FULL", 3, "OK")
    resume_source(store, "src")
    assert not st.spaces_due(sync.spaces, store.state("src"), sync.now, timedelta(days=9), timedelta(0)).isEmpty()
