"""Requests as a data source: planning, pushdown, streams, gaps; and what a store keeps of many runs."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F, types as T

from syncspark.config import SyncConfig
from syncspark.operators.changes import frequent_messages, gapless_end
from syncspark.plans.store import FAN, SyncStore
from syncspark.plans.sync import sync_once, utc
from syncspark.sources.paged import BATCH_CHARS, Request, page_source, source_reader
from syncspark.sources.client import Page
from syncspark.sources.reads import scan_updated_per_space
from tests.test_client import DOC, DOCS, make_client

CFG = dict(source="src", document_id="id", updated="updated", fields={"title": "title"}, full_update_period=timedelta(0))


def failing(client, bad):
    class Failing:
        def page(self, space_key, start_at, full, updated_after, updated_before):
            if updated_after is not None and updated_after.day == bad:
                raise OSError("gone")
            return client.page(space_key, start_at, full, updated_after, updated_before)

        def newest(self):
            return "2024-01-05T00:00:00"

    return Failing()


def load(spark, name, **options):
    reader = spark.read.format(name)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def test_requests_are_partitions_and_filters_choose_them(spark):
    spark.dataSource.register(page_source(make_client(DOCS), "t_plain"))
    many = load(spark, "t_plain", spaces=",".join(f"X{k}" for k in range(198)) + ",A,B")
    assert many.rdd.getNumPartitions() == 200
    assert many.filter("space_key = 'A'").rdd.getNumPartitions() == 1
    assert {r.space_key for r in many.filter("space_key IN ('A', 'X3')").collect()} == {"A", "X3"}
    cut = load(spark, "t_plain", spaces="A,B", after="2024-01-01", until="2024-01-05", span="1d")
    assert cut.rdd.getNumPartitions() == 8
    late = cut.filter(F.col("updated_after") >= F.lit("2024-01-03").cast("timestamp"))
    assert late.rdd.getNumPartitions() == 4 and {r.slice for r in late.collect()} == {2, 3}
    assert cut.filter("space_key = 'none'").count() == 0


@pytest.mark.parametrize("mode, stored", [("simple", 2), ("pagination", 5), ("updateTimestamp", 5)])
def test_read_modes(spark, tmp_path, mode, stored):
    spark.dataSource.register(page_source(make_client(DOCS), f"t_{mode}"))
    store, cfg = SyncStore(spark, str(tmp_path)), SyncConfig(**CFG, read_mode=mode)
    spaces = spark.createDataFrame([("src", "A"), ("src", "B")], "source string, space_key string")
    report = sync_once(store, cfg, spaces, source_reader(spark, cfg, f"t_{mode}", DOC, "items"), utc(2024, 2, 1))
    assert {(r.space_key, r.full, r.documents_updated, r.ok) for r in report.runs.collect()} == {(s, True, stored, True) for s in "AB"}


def test_a_gap_holds_the_update_time_back(spark, tmp_path):
    spark.dataSource.register(page_source(make_client(DOCS[:2] + DOCS[5:7]), "t_two"))
    spark.dataSource.register(page_source(failing(make_client(DOCS), 3), "t_gap"))
    spark.dataSource.register(page_source(make_client(DOCS), "t_all"))
    store = SyncStore(spark, str(tmp_path))
    cfg = SyncConfig(**CFG, slice_span=timedelta(days=1), first_update=utc(2024, 1, 1))
    spaces = spark.createDataFrame([("src", "A"), ("src", "B")], "source string, space_key string")

    def run(name, now):
        rows = sync_once(store, cfg, spaces, source_reader(spark, cfg, name, DOC, "items", now=now), now).runs.collect()
        marks = {r.space_key: r.value.isoformat() for r in store.state("src").filter("property = 'watermark'").collect()}
        return {(r.space_key, r.ok, r.documents_updated, r.error_message) for r in rows}, marks

    run("t_two", utc(2024, 1, 3))
    found, marks = run("t_gap", utc(2024, 1, 6))
    # Slices begin on the 2nd, 3rd (fails), 4th and 5th; a day's document is on two borders.
    assert found == {(s, True, 5, "OSError: gone") for s in "AB"}
    assert marks == {s: "2024-01-03T00:00:00" for s in "AB"}
    assert store.current().count() == 10
    found, marks = run("t_all", utc(2024, 1, 7))
    assert all(ok and message is None for _, ok, _, message in found) and marks == {s: "2024-01-05T00:00:00" for s in "AB"}
    # A full run with a gap fails, lest it removes what it could not read.
    other = SyncStore(spark, str(tmp_path / "other"))
    found = sync_once(other, cfg, spaces, source_reader(spark, cfg, "t_gap", DOC, "items", now=utc(2024, 1, 6)), utc(2024, 1, 6)).runs
    assert {(r.full, r.ok, r.error_message) for r in found.collect()} == {(True, False, "OSError: gone")}


def test_stream_of_requests(spark, tmp_path):
    spark.dataSource.register(page_source(failing(make_client(DOCS), 99), "t_stream"))
    stream = spark.readStream.format("t_stream").option("spaces", "A,B").option("after", "2024-01-02").option("span", "1d").load()
    running = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(once=True).format("parquet").start(str(tmp_path / "out"))
    running.awaitTermination()
    pages = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.space_key, r.slice) for r in pages} == {(s, k) for s in "AB" for k in range(3)}
    assert {d["id"] for r in pages for d in json.loads(r.payload)["items"]} == {d["id"] for d in DOCS if d["updated"] >= "2024-01-02"}


def test_gapless_end(spark):
    rows = [("A", 0, True, 10), ("A", 2, True, 30), ("A", 1, True, 20), ("A", 4, True, 50), ("B", 1, True, 20), ("C", 0, False, 10), ("C", 0, True, 10), ("C", 1, False, 20)]
    found = gapless_end(spark.createDataFrame(rows, "space_key string, slice long, finished boolean, updated_before long"), ["space_key"])
    assert {tuple(r) for r in found.collect()} == {("A", 3, 30), ("C", 1, 10)}


def test_any_number_of_messages_is_a_few_lines(spark):
    kinds = spark.range(100_000).selectExpr("'s' as k", "concat('m', id) as message", "if(id = 77, 5, 1) as n")
    row = frequent_messages(kinds, ["k"], 3).first()
    assert row.messages == "m0\nm1\nm77\nand 99997 more kinds of messages"


def test_bound_reaches_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("concat('S', id % 2) as space_key", "timestamp_seconds(id * 86400) as updated").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    marks = spark.createDataFrame([("S0", utc(1970, 1, 5)), ("S1", None)], "space_key string, updated_after timestamp")
    found = scan_updated_per_space(docs, "updated", marks)
    assert sorted((r.space_key, r.updated.day) for r in found.collect()) == [("S0", d) for d in (5, 7, 9)] + [("S1", d) for d in (2, 4, 6, 8, 10)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(updated,1970-01-05" in plan


def test_compaction(spark, tmp_path):
    """Folding keeps the rows, also of documents that moved between spaces or were deleted."""
    store = SyncStore(spark, str(tmp_path))
    schema = store.rows().drop("source", "space_key", "run_id", "op").schema

    def add(run, space, op, docs, full=False):
        rows = [("document", k, None, k, f"{k} {run}", None, None, 0, i, None) for i, k in enumerate(docs)]
        df = spark.createDataFrame(rows, schema).selectExpr("*", "'src' as source", f"'{space}' as space_key", f"cast({run} as bigint) as run_id", f"'{op}' as op")
        df.write.mode("append").partitionBy("source", "space_key", "run_id", "op").parquet(store.path("rows"))
        store.commit(spark.createDataFrame([("src", space, full)], "source string, space_key string, full boolean"), run)

    def now(columns=("body",)):
        return sorted(map(tuple, store.current(columns=list(columns)).collect()))

    add(1, "A", "upsert", ["a", "b", "c", "m"], full=True)
    add(2, "A", "upsert", ["b", "d"])
    add(3, "A", "delete", ["c", "d"])
    add(4, "B", "upsert", ["m", "x"], full=True)
    add(5, "B", "delete", ["m", "x"])
    before = now()
    assert [r[1] for r in before] == ["a", "b"] and store.compact(fan=2) == 5 and now() == before
    live = store.live_runs().groupBy("space_key").count().collect()
    assert {r["count"] for r in live} == {1} and store.dead_runs().count() == 5
    # A run that began earlier and comes late keeps its place in the order.
    add(6, "A", "upsert", ["c"])
    add(7, "A", "delete", ["a"])
    after = now()
    assert [r[1] for r in after] == ["b", "c"]
    store.compact(fan=2)
    assert now() == after
    for run in range(20, 20 + 2 * FAN):
        add(run, "B", "upsert", [f"n{run}"])
    after = now()
    while store.compact():
        assert now() == after
    assert store.live_runs().count() <= 2 * FAN


def test_state_is_a_log_with_snapshots(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("syncspark.plans.store.SNAPSHOT", 3)
    store = SyncStore(spark, str(tmp_path))
    for g in range(1, 8):
        rows = [("src", "A", "watermark", utc(2024, 1, g)), ("src", f"S{g}", "last_start", utc(2024, 2, g)), ("src", f"S{g - 1}", "last_start", None)]
        store.write_state(spark.createDataFrame(rows, "source string, space_key string, property string, value timestamp"), "src", g)
    assert {(r.space_key, r.property, r.value.day) for r in store.state("src").collect()} == {("A", "watermark", 7), ("S7", "last_start", 7)}
    assert spark.read.parquet(store.path("snapshots")).select("generation").distinct().count() == 2


def test_answers_reach_spark_in_bounded_batches(spark):
    """However many answers a request has, a few at a time leave the worker."""
    size, pages, asked = 100_000, 200, []
    make_page = Page

    class Large:
        def page(self, space_key, start_at, full, updated_after, updated_before):
            asked.append(start_at)
            return make_page(json.dumps([{"id": str(start_at)}]).ljust(size), 1, pages)

    source = page_source(Large(), "t_large")
    batches = source({}).reader(None).read(Request("A"))
    first = next(batches)
    assert first.num_rows == len(asked) <= BATCH_CHARS // size + 1
    assert first.num_rows + sum(b.num_rows for b in batches) == pages
    spark.dataSource.register(source)
    rows = load(spark, "t_large", spaces="A,B").selectExpr("space_key", "page_no", "start_at", "total", "trim(payload) as p", "error").collect()
    assert sorted(map(tuple, rows)) == [(s, k, k, pages, json.dumps([{"id": str(k)}]), None) for s in "AB" for k in range(pages)]
