"""The physical plans behind the operators: what is read, shuffled and broadcast."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from syncspark.config import SyncConfig
from syncspark.operators import changes as ch, comments as cm
from syncspark.operators.joins import keyed_join
from syncspark.plans.store import ROWS_PARTITIONS, SyncStore
from syncspark.plans.sync import target_rows, utc
from syncspark.sources import reads, sitemap as sm
from syncspark.sources.html import html_extract

CONFIG = SyncConfig(
    source="src", document_id="id", read_mode="simple", fields={"v": "v"}, comment_mode="child", comments="notes",
    comment_id="id", comment_type="note", field_comments="notes", comment_fields={"t": "t"},
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, what):
    return len(re.findall(what, plan(df)))


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "docs")
    spark.range(1000).select(
        F.col("id").cast("string").alias("id"), F.concat(F.lit("S"), (F.col("id") % 4).cast("string")).alias("spaceKey"),
        F.col("id").alias("v"), F.lit("unused").alias("wide"), F.lit(0).alias("page_no"), F.col("id").cast("int").alias("pos"),
        F.timestamp_seconds(F.col("id")).alias("ts"),
        F.array(F.struct(F.concat(F.lit("c"), F.col("id").cast("string")).alias("id"), F.lit("t").alias("t"))).alias("notes"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_documents_and_comments_come_from_one_scan_without_a_shuffle(docs):
    rows = cm.index_rows(docs, CONFIG)
    assert count(rows, "FileScan") == 1 and count(rows, "Exchange") == 0
    assert "wide" not in plan(rows) and "ts#" not in plan(rows)
    assert count(rows, "BatchEvalPython|ArrowEvalPython") == 0
    stored = target_rows(docs, CONFIG, utc(2024, 1, 1), 1, strict=False)
    assert count(stored, "FileScan") == 1 and count(stored, "Exchange") == 0


def test_newest_row_per_key_is_reduced_before_the_shuffle(docs):
    newest = ch.latest(docs.select("spaceKey", "v", "pos"), ["spaceKey"], ["pos"])
    assert count(newest, "Exchange hashpartitioning") == 1 and count(newest, "partial_max_by") == 1
    assert count(newest, "Window") == 0


def test_snapshot_diff_shuffles_once(docs):
    half = docs.select("id", "v")
    assert count(ch.snapshot_diff(half, half, ["id"], ["v"]), "Exchange hashpartitioning") == 1


def test_update_filter_reaches_the_scan(docs):
    found = reads.scan_updated(docs.select("id", "ts"), "ts", datetime(1970, 1, 1, 0, 5))
    assert "GreaterThanOrEqual(ts,1970-01-01 00:05:00.0)" in plan(found) and "ReadSchema: struct<id:string,ts:timestamp>" in plan(found)
    assert found.count() == 700


def test_small_sides_leave_the_large_one_in_place(docs):
    spaces = docs.select(F.col("spaceKey").alias("space_key")).distinct().withColumn("updated_after", F.lit(None).cast("timestamp"))
    joined = reads.scan_updated_per_space(docs.withColumn("space_key", F.col("spaceKey")).select("space_key", "ts", "v"), "ts", spaces)
    assert "BroadcastHashJoin" in plan(joined) and "SortMergeJoin" not in plan(joined)


def test_large_sides_are_not_broadcast(docs, monkeypatch):
    from syncspark.operators import joins

    monkeypatch.setattr(joins, "is_small", lambda *a, **k: False)
    spark = docs.sparkSession
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        side = docs.select("spaceKey").distinct()
        salted = keyed_join(docs.select("spaceKey", "v"), side, ["spaceKey"], "left_semi", hot=True)
        plain = keyed_join(docs.select("spaceKey", "v"), side, ["spaceKey"], "left_semi")
        assert "_salt" in plan(salted) and "Broadcast" not in plan(salted)
        assert "_salt" not in plan(plain) and "Broadcast" not in plan(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)


def test_python_only_for_html(docs):
    pages = docs.select("id", F.lit("<p>x</p>").alias("html"))
    assert count(html_extract(pages, {"a": {"cssSelector": "p"}}), "ArrowEvalPython") == 1
    assert count(html_extract(pages), "EvalPython") == 0
    bodies = docs.select(F.lit("http://x.org/m.xml").alias("sitemap_url"), F.lit("text/xml").alias("content_type"), F.col("wide").alias("body"))
    assert count(sm.read_sitemap(bodies), "EvalPython") == 0 and count(sm.read_sitemap(bodies), "Exchange") == 0


def test_key_reads_of_the_target_skip_bodies_and_old_runs(docs, tmp_path):
    store = SyncStore(docs.sparkSession, str(tmp_path / "s"))
    for run_id in (1, 2):
        rows = target_rows(docs, CONFIG, utc(2024, 1, run_id), run_id)
        rows.write.mode("append").partitionBy(*ROWS_PARTITIONS).parquet(store.path("rows"))
        runs = rows.select("source", "space_key", "run_id", F.lit(True).alias("full")).distinct()
        runs.write.mode("append").parquet(store.path("runs"))
    keys = store.current(columns=[])
    assert not re.search(r"ReadSchema: struct<[^>]*body", plan(keys))
    live = keyed_join(store.rows(), store.live_runs(), ["source", "space_key", "run_id"], "left_semi", hot=True)
    assert "dynamicpruning" in plan(live)
    assert keys.count() == 2000
    assert store.current().filter(F.col("indexed_at") < F.lit(utc(2024, 1, 2))).isEmpty()
