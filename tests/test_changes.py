"""Applying changes to rows that are plain DataFrames, checked against a replay in Python."""

import random
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as hst
from pyspark.sql import functions as F

from syncspark.errors import ConfigError, WriteFailedError
from syncspark.operators import changes as ch, joins, sinks
from syncspark.plans.sync import utc

ROW = "doc_type string, doc_id string, parent_id string, source string, space_key string, document_id string, body string"
START = utc(2024, 1, 1)
NOW = utc(2024, 2, 1)


def target_of(spark, rows):
    return spark.createDataFrame(
        [("comment" if "/" in k else "document", k, None, "src", "S", k.split("/")[0], body, START) for k, body in rows.items()],
        ROW + ", indexed_at timestamp",
    )


def changes_of(spark, log):
    """``log``: (document, comment ids or None for a delete), in order."""
    upserts, deletes = [], []
    for n, (doc, comments) in enumerate(log):
        if comments is None:
            deletes.append(("src", "S", doc, n // 3, n % 3))
        else:
            for key in [doc, *[f"{doc}/{c}" for c in comments]]:
                kind = "comment" if "/" in key else "document"
                upserts.append((kind, key, None, "src", "S", doc, f"v{n}", n // 3, n % 3))
    return ch.Changes(
        spark.createDataFrame(upserts, ROW + ", page_no int, pos int"),
        spark.createDataFrame(deletes, "source string, space_key string, document_id string, page_no int, pos int"),
    )


def replay(rows, log):
    rows = dict(rows)
    for n, (doc, comments) in enumerate(log):
        if comments is None:
            rows = {k: v for k, v in rows.items() if k.split("/")[0] != doc}
        else:
            rows.update({k: f"v{n}" for k in [doc, *[f"{doc}/{c}" for c in comments]]})
    return rows


def applied(spark, rows, log):
    out = ch.apply_changes(target_of(spark, rows), changes_of(spark, log), ["page_no", "pos"], NOW, ["document", "comment"])
    return {r.doc_id: r.body for r in out.collect()}


def random_case(rng):
    docs = ["a", "b", "c", "d"]
    rows = {k: "old" for d in docs if rng.random() < 0.7 for k in [d, *[f"{d}/{c}" for c in range(rng.randint(0, 2))]]}
    log = [
        (rng.choice(docs), None if rng.random() < 0.3 else [str(c) for c in range(4) if rng.random() < 0.4])
        for _ in range(rng.randint(1, 10))
    ]
    return rows, log


def test_batch_equals_replay_in_order(spark):
    rng = random.Random(7)
    for _ in range(6):
        rows, log = random_case(rng)
        assert applied(spark, rows, log) == replay(rows, log), (rows, log)


def test_joins_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(joins, "is_small", lambda *a, **k: False)
    rng = random.Random(11)
    for _ in range(2):
        rows, log = random_case(rng)
        assert applied(spark, rows, log) == replay(rows, log), (rows, log)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, monkeypatch, how):
    """Most rows of the left side have one key, and many are exact copies."""
    left = spark.range(2000, numPartitions=5).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 50).alias("k"), (F.col("id") % 4).alias("v")
    )
    right = spark.range(0, 30).select((F.col("id") * 2).alias("k"), F.col("id").alias("w"))
    plain = left.join(right, ["k"], how)
    monkeypatch.setattr(joins, "is_small", lambda *a, **k: False)
    salted = joins.keyed_join(left, right, ["k"], how, hot=True)
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()
    sizes = left.withColumn("p", F.spark_partition_id()).join(right, "k").groupBy("k").count()
    assert sizes.agg(F.max("count")).first()[0] > 1000


def test_size_is_measured(spark):
    assert joins.is_small(spark.range(10)) and not joins.is_small(spark.range(11), max_rows=10)
    wide = spark.range(4).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert joins.is_small(wide, max_bytes=5000) and not joins.is_small(wide, max_bytes=4000)
    plan = joins.keyed_join(spark.range(5).toDF("k"), spark.range(5).toDF("k"), ["k"], "left_semi")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan


def test_stale_rows_are_scoped(spark):
    rows = [("document", "1", "src", "S", NOW), ("document", "2", "src", "S", START), ("document", "3", "src", "T", START),
            ("document", "4", "other", "S", START), ("comment", "5", "src", "S", START)]
    target = spark.createDataFrame(rows, "doc_type string, doc_id string, source string, space_key string, indexed_at timestamp")

    def left(types, spaces=("S",)):
        return sorted(r.doc_id for r in ch.stale_delete(target, "src", spaces and list(spaces), NOW, types).collect())

    assert left(["document", "comment"]) == ["1", "3", "4"]
    assert left(["document"]) == ["1", "3", "4", "5"]
    assert left(["document", "comment"], None) == ["1", "4"]


def test_flagged_delete_is_scoped(spark):
    rows = [("document", "1", "src", "S", "1"), ("comment", "9", "src", "S", "1"), ("document", "1b", "src", "T", "1"), ("document", "1c", "x", "S", "1")]
    target = spark.createDataFrame(rows, "doc_type string, doc_id string, source string, space_key string, document_id string")
    gone = spark.createDataFrame([("src", "S", "1")] * 2, "source string, space_key string, document_id string")
    assert sorted(r.doc_id for r in ch.flagged_delete(target, gone, ["document", "comment"]).collect()) == ["1b", "1c"]
    assert sorted(r.doc_id for r in ch.flagged_delete(target, gone, ["document"]).collect()) == ["1b", "1c", "9"]
    counted = ch.delete_counters(ch.removed_by(target, gone, ["document", "comment"]), "document").first()
    assert (counted.documents_deleted, counted.comments_deleted) == (1, 1)


def read_log(spark, *rows):
    return spark.createDataFrame(
        [("src", "S", p, i, utc(2024, 1, 1, 0, m), r, w) for p, i, m, r, w in rows],
        "source string, space_key string, page_no int, pos int, updated timestamp, reachable boolean, wrote boolean",
    )


def mark(spark, *rows):
    row = ch.watermark_advance(read_log(spark, *rows)).select(F.date_format("watermark", "mm").alias("m")).first()
    return int(row.m) if row else None


def test_watermark_is_the_last_in_page_order(spark):
    assert mark(spark, (0, 0, 52, True, True), (0, 1, 28, True, True)) == 28
    assert mark(spark, (0, 0, 10, True, True), (0, 1, 11, False, True)) == 10
    assert mark(spark, (0, 0, 10, True, True), (1, 0, 30, True, False)) == 10
    assert mark(spark, (0, 0, 10, True, True), (1, 0, 30, True, False), (1, 1, 29, True, True)) == 29
    assert mark(spark, (0, 0, 10, False, True), (1, 0, 30, True, False)) is None


def test_watermark_bump(spark):
    rows = spark.createDataFrame([(1, START, START, 1), (2, START, START, 0), (3, START, NOW, 1), (4, None, NOW, 1)],
                                 "i int, s timestamp, e timestamp, n int")
    out = rows.select("i", ch.watermark_bump(F.col("s"), F.col("e"), F.col("n")).alias("w"))
    shift = {r.i: r.d for r in out.join(rows, "i").select("i", (F.unix_seconds("w") - F.unix_seconds("e")).alias("d")).collect()}
    assert shift == {1: 1, 2: 0, 3: 0, 4: 0}


def test_full_promotion(spark):
    spaces = spark.createDataFrame([("src", "A", False), ("src", "B", False), ("src", "C", True)], "source string, space_key string, full boolean")
    marks = spark.createDataFrame([("src", "A", START), ("src", "C", START)], "source string, space_key string, watermark timestamp")
    rows = {r.space_key: (r.full, r.updated_after is None) for r in ch.effective_kind(spaces, marks).collect()}
    assert rows == {"A": (False, False), "B": (True, True), "C": (True, True)}


def test_outcome(spark):
    runs = spark.createDataFrame(
        [("src", "A", START, START + timedelta(seconds=2), None), ("src", "B", START, START, "broke ")],
        "source string, space_key string, start_date timestamp, end_date timestamp, failure string",
    )
    errors = spark.createDataFrame([("src", "A", m) for m in ("x", " x", "", "b")] + [("src", "B", "y")], "source string, space_key string, message string")
    rows = {r.space_key: (r.result, r.time_elapsed, r.documents_with_error, r.error_message) for r in ch.run_outcome(runs, errors).collect()}
    assert rows == {"A": ("OK", 2000, 3, "b\nx"), "B": ("ERROR", 0, 1, "y\nbroke")}


def test_snapshot_diff(spark):
    before = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    after = spark.createDataFrame([("b", 2), ("c", 4), ("d", 5)], "k string, v int")
    rows = {r.k: r.status for r in ch.snapshot_diff(before, after, ["k"], ["v"]).collect()}
    assert rows == {"a": "removed", "b": "unchanged", "c": "changed", "d": "added"}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=hst.lists(hst.tuples(hst.integers(0, 3), hst.integers(0, 100)), min_size=1, max_size=30))
def test_latest_keeps_the_newest_row(spark, rows):
    seen = [(k, n, o) for o, (k, n) in enumerate(rows)]
    df = spark.createDataFrame(seen, "k int, n int, o int").repartition(3)
    out = {r.k: r.n for r in ch.latest(df, ["k"], ["o"]).collect()}
    assert out == {k: n for k, n, _ in seen}


def test_write_documents(spark, tmp_path):
    rows = spark.range(10).withColumn("p", F.col("id") % 2)
    target, computed = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            computed.add(len(frame))
            yield frame

    once = rows.mapInPandas(count, rows.schema)
    result = sinks.write_documents(once, F.when(F.col("id") < 8, F.col("id") != 3), target, ["p"])
    assert (result.written, result.failed) == (7, 3) and computed.value == 10
    assert sinks.stored(spark, target, rows.schema).count() == 7
    refused = sinks.stored(spark, target, rows.schema, refused=True)
    assert {r.id for r in refused.collect()} == {3, 8, 9}
    assert "PartitionFilters: [isnotnull(refused" in refused._jdf.queryExecution().toString()
    with pytest.raises(WriteFailedError):
        sinks.write_documents(rows, F.lit(False), target, ["p"])
    assert sinks.stored(spark, target, rows.schema, refused=True).count() == 13
    assert sinks.write_documents(rows.limit(0), F.lit(True), target, ["p"]).written == 0
    with pytest.raises(ConfigError):
        sinks.write_documents(rows.withColumn("refused", F.lit(1)), F.lit(True), target)
