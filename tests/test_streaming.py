import json
import os

import pytest
from pyspark.sql import functions as F

from syncspark.config import SyncConfig
from syncspark.plans.store import SyncStore
from syncspark.plans.sync import sync_once, utc
from syncspark.streaming import sync as stream

SCHEMA = "id string, spaceKey string, updated timestamp, kind string, notes array<struct<id:string,text:string>>, page_no int, pos int"
CONFIG = SyncConfig(
    source="src", document_id="id", updated="updated", deleted="kind", deleted_value="gone", fields={"kind": "kind"},
    comment_mode="child", comments="notes", comment_id="id", comment_type="note", field_comments="notes",
    comment_fields={"text": "text"},
)


def write_batch(folder, number, docs):
    lines = []
    for pos, (key, minute, kind, notes) in enumerate(docs):
        lines.append(json.dumps({
            "id": key, "spaceKey": "S" + key[0], "updated": f"2024-01-01T00:{minute:02d}:00Z", "kind": kind,
            "notes": [{"id": f"{key}/{n}", "text": f"m{minute}"} for n in notes], "page_no": number, "pos": pos,
        }))
    file = folder / f"b{number}.json"
    file.write_text("\n".join(lines))
    # The stream takes files by their time; equal times would leave the order open.
    os.utime(file, (1_700_000_000 + number, 1_700_000_000 + number))


BATCHES = [
    [("a1", 1, "new", "xy"), ("b1", 2, "new", "x")],
    [("a1", 3, "changed", "xz"), ("b1", 4, "gone", "")],
    [("a2", 5, "new", ""), ("b1", 6, "again", "q"), ("a1", 2, "late", "")],
]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in"


def source(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def keys(store):
    return {(r.doc_type, r.doc_id): json.loads(r.body) for r in store.current().collect()}


def test_stream_equals_arrival_order(spark, folder, tmp_path):
    store = SyncStore(spark, str(tmp_path / "store"))
    start = lambda: run(stream.continuous_sync(source(spark, folder), store, CONFIG, str(tmp_path / "cp"), clock=lambda: utc(2024, 2, 1)))
    for number, docs in enumerate(BATCHES[:2]):
        write_batch(folder, number, docs)
    start()
    found = keys(store)
    # The old note y of a1 stays, as an incremental change does not remove it.
    assert set(found) == {("document", "a1"), ("note", "a1/x"), ("note", "a1/y"), ("note", "a1/z")}
    assert found["document", "a1"]["kind"] == "changed" and found["note", "a1/x"]["text"] == "m3"
    # A restart continues from the checkpoint and reads only what is new.
    write_batch(folder, 2, BATCHES[2])
    start()
    found = keys(store)
    assert found["document", "a1"]["kind"] == "late" and found["document", "b1"]["kind"] == "again"
    assert {k for t, k in found if t == "note"} == {"a1/x", "a1/y", "a1/z", "b1/q"}
    runs = store.runs().join(store.activity().select("space_key", "start_date").distinct(), "space_key").orderBy("run_id")
    assert [r.batch_id for r in runs.select("run_id", "batch_id").distinct().orderBy("run_id").collect()] == [0, 1, 2]
    totals = store.activity().agg(F.sum("documents_updated"), F.sum("documents_deleted"), F.sum("comments_deleted")).first()
    assert tuple(totals) == (6, 1, 1) and store.activity().filter("result <> 'OK'").isEmpty()


def sync(spark, folder, store, checkpoint, now=utc(2024, 2, 1)):
    run(stream.continuous_sync(source(spark, folder), store, CONFIG, str(checkpoint), clock=lambda: now))


def test_new_checkpoint_and_second_stream_take_nothing_away(spark, folder, tmp_path):
    store = SyncStore(spark, str(tmp_path / "store"))
    write_batch(folder, 0, BATCHES[0])
    sync(spark, folder, store, tmp_path / "one")
    found = keys(store)
    sync(spark, folder, store, tmp_path / "two")
    assert keys(store) == found and len(found) == 5
    (tmp_path / "other").mkdir()
    write_batch(tmp_path / "other", 0, [("c1", 7, "new", "x")])
    sync(spark, tmp_path / "other", store, tmp_path / "three")
    assert len(keys(store)) == 7


def test_stream_pass_stream(spark, folder, tmp_path):
    """A full pass restarts its spaces; streamed rows before it go, later ones stay."""
    store = SyncStore(spark, str(tmp_path / "store"))
    write_batch(folder, 0, BATCHES[0])
    sync(spark, folder, store, tmp_path / "cp")
    docs = spark.createDataFrame([("a9", "Sa", utc(2024, 1, 1, 1), "new", [], 0, 0)], SCHEMA)
    spaces = spark.createDataFrame([("src", "Sa")], "source string, space_key string")
    assert sync_once(store, CONFIG, spaces, lambda due: docs, utc(2024, 2, 2)).runs.first().ok
    write_batch(folder, 1, [("a2", 70 % 60, "new", "")])
    sync(spark, folder, store, tmp_path / "cp", utc(2024, 2, 3))
    found = {k for t, k in keys(store) if t == "document"}
    assert {"b1", "a2"} <= found and ("a1" in found) == (not store.runs().filter("full and space_key = 'Sa'").count())


@pytest.mark.parametrize("broken", ["commit", "write_state", "save"])
def test_batch_that_dies_is_stored_once(spark, folder, tmp_path, monkeypatch, broken):
    store = SyncStore(spark, str(tmp_path / "store"))
    write_batch(folder, 0, BATCHES[0])

    def dies(*args, **options):
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as patch:
        patch.setattr(store, broken, dies)
        with pytest.raises(Exception, match="the driver is lost"):
            sync(spark, folder, store, tmp_path / "cp")
    sync(spark, folder, store, tmp_path / "cp")
    assert len(keys(store)) == 5 and store.runs().select("run_id").distinct().count() == 1


def test_documents_that_cannot_be_stored_are_counted(spark, folder, tmp_path):
    store = SyncStore(spark, str(tmp_path / "store"))
    write_batch(folder, 0, [("a1", 1, "new", "x"), ("a2", 2, "new", "")])
    text = (folder / "b0.json").read_text().replace('"updated": "2024-01-01T00:02:00Z", ', "")
    (folder / "b0.json").write_text(text)
    sync(spark, folder, store, tmp_path / "cp")
    record = store.activity().first()
    assert set(keys(store)) == {("document", "a1"), ("note", "a1/x")}
    assert (record.documents_updated, record.documents_with_error, record.result) == (1, 1, "OK") and "a2" in record.error_message


def test_latest_by_key_ignores_older_changes(spark, folder, tmp_path):
    for number, docs in enumerate(BATCHES):
        write_batch(folder, number, docs)
    docs = source(spark, folder).withColumn("gone", F.col("kind") == "gone")
    latest = stream.latest_by_key(docs, ["id"], ["updated"], "gone", ["kind"])
    run(stream.write_latest(latest, str(tmp_path / "out"), str(tmp_path / "cp")))
    out = stream.read_latest(spark.read.parquet(str(tmp_path / "out")), ["id"])
    assert {r.id: r.kind for r in out.collect()} == {"a1": "changed", "a2": "new", "b1": "again"}


def test_rereads_are_absorbed_across_batches(spark, folder, tmp_path):
    write_batch(folder, 0, [("a1", 1, "new", ""), ("a2", 2, "new", "")])
    write_batch(folder, 1, [("a2", 2, "new", ""), ("a1", 3, "new", "")])
    write_batch(folder, 2, [("a9", 0, "new", "")])  # late, and kept
    once = stream.absorb_rereads(source(spark, folder), ["id"], "updated").select("id", "updated")
    run(once.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out")))
    assert spark.read.schema(once.schema).parquet(str(tmp_path / "out")).count() == 4


def test_period_is_a_processing_time_trigger(spark, folder, tmp_path):
    store = SyncStore(spark, str(tmp_path / "store"))
    write_batch(folder, 0, BATCHES[0])
    running = stream.continuous_sync(source(spark, folder), store, CONFIG, str(tmp_path / "cp"), period="1 second", clock=lambda: utc(2024, 2, 1))
    running.processAllAvailable()
    running.stop()
    assert len(keys(store)) == 5
