import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from syncspark.operators import activity as act, state as st
from syncspark.plans.sync import utc

NOW = utc(2024, 6, 1, 12)
ALL = "source string, space_key string"


@pytest.fixture
def make(spark):
    return lambda *rows: spark.createDataFrame([("src", *r) for r in rows], st.STATE_SCHEMA)


def spaces(spark, *keys):
    return spark.createDataFrame([("src", k) for k in keys], ALL)


def values(df):
    return {(r.space_key, r.property): r.value for r in df.select("space_key", "property", F.unix_seconds("value").alias("value")).collect()}


def test_put_get_delete(spark, make):
    start = make(("A", "watermark", utc(2024, 1, 1)), (None, "stopped", utc(2024, 1, 2)))
    put = st.state_put(start, make(("A", "watermark", utc(2024, 1, 3)), ("B", "watermark", utc(2024, 1, 4)), (None, "stopped", None)))
    assert set(values(put)) == {("A", "watermark"), ("B", "watermark")}
    assert [r.space_key for r in st.state_get(put, "watermark").filter(F.col("watermark") == F.lit(utc(2024, 1, 3))).collect()] == ["A"]
    left, existed = st.state_delete(start, make(("A", "watermark", None), ("C", "watermark", None), (None, "stopped", None)))
    assert left.isEmpty()
    assert {r.space_key: r.existed for r in existed.collect()} == {"A": True, "C": False, None: True}
    keys = start.select(st.state_key(F.col("property"), F.col("space_key")).alias("k")).collect()
    assert {r.k for r in keys} == {"_watermark_A", "_stopped"}


def due(spark, make, rows, period=timedelta(hours=1), full=timedelta(0), calendar=None):
    known = spaces(spark, "A")
    if calendar is not None:
        known = known.withColumn("next_full_at", F.lit(calendar))
    found = st.spaces_due(known, make(*rows) if rows else make(("other", "x", NOW)), NOW, period, full).collect()
    return [r["full"] for r in found]


def ago(**span):
    return NOW - timedelta(**span)


def test_due(spark, make):
    assert due(spark, make, []) == [False]
    assert due(spark, make, [("A", st.LAST_START, ago(minutes=59))]) == []
    assert due(spark, make, [("A", st.LAST_START, ago(minutes=61))]) == [False]
    assert due(spark, make, [("A", st.LAST_START, ago(days=61))], period=timedelta(0)) == []
    assert due(spark, make, [("A", st.LAST_START, ago(minutes=1)), ("A", st.FORCE_INCREMENTAL, NOW)]) == [False]
    assert due(spark, make, [("A", st.LAST_START, ago(minutes=1)), ("A", st.FORCE_FULL, NOW)]) == [True]
    recent = [("A", st.LAST_START, ago(minutes=1)), ("A", st.LAST_FULL, ago(hours=13))]
    assert due(spark, make, recent, full=timedelta(hours=12)) == [True]
    assert due(spark, make, recent, full=timedelta(hours=14)) == []
    assert due(spark, make, recent[:1], full=timedelta(hours=14)) == [True]
    assert due(spark, make, recent, full=timedelta(hours=1), calendar=ago(seconds=-1)) == []
    assert due(spark, make, recent, calendar=ago(seconds=1)) == [True]
    assert due(spark, make, [(None, st.STOPPED, NOW)]) == []


def test_finish(spark):
    runs = spark.createDataFrame(
        [("src", "inc", False, True), ("src", "bad", False, False), ("src", "full", True, True), ("src", "fail", True, False)],
        "source string, space_key string, full boolean, ok boolean",
    )
    never = values(st.finish(runs, NOW, timedelta(0)))
    assert {k: v is not None for k, v in never.items()} == {
        ("inc", st.FORCE_INCREMENTAL): False, ("bad", st.FORCE_INCREMENTAL): False,
        ("full", st.FORCE_INCREMENTAL): False, ("full", st.FORCE_FULL): False, ("full", st.LAST_FULL): True,
        ("fail", st.FORCE_INCREMENTAL): False, ("fail", st.FORCE_FULL): True,
    }
    assert ("fail", st.FORCE_FULL) not in values(st.finish(runs, NOW, timedelta(hours=1)))


def test_force(spark):
    known = spaces(spark, "A", "B")
    assert st.force(known, st.FORCE_FULL, NOW).count() == 2
    assert st.force(known, st.FORCE_FULL, NOW, " ").count() == 2
    assert [r.space_key for r in st.force(known, st.FORCE_INCREMENTAL, NOW, "B").collect()] == ["B"]
    assert st.force(known, st.FORCE_INCREMENTAL, NOW, "X").isEmpty()
    with pytest.raises(ValueError):
        st.force(known, "other", NOW)


RUNS = "source string, space_key string, full boolean, start_date timestamp, documents_updated int, documents_deleted int, comments_deleted int, documents_with_error int, ok boolean, time_elapsed long, error_message string"


@pytest.fixture
def runs(spark):
    return spark.createDataFrame(
        [
            ("src", "A", True, utc(2024, 5, 1, 10), 10, 1, 12, 3, True, 1250, " "),
            ("src", "A", False, utc(2024, 5, 1, 12), 11, 2, 0, 0, False, 125, "Error message"),
            ("src", "B", False, utc(2024, 5, 1, 11), 1, 0, 0, 0, True, 7, None),
        ],
        RUNS,
    )


def test_activity_record_round_trip(runs):
    records = act.activity_json(runs)
    first = json.loads(records.filter("record LIKE '%1250ms%'").first().record)
    assert first == {
        "source": "src", "space_key": "A", "update_type": "FULL", "start_date": "2024-05-01T10:00:00.000Z",
        "documents_updated": 10, "documents_deleted": 1, "comments_deleted": 12, "documents_with_error": 3,
        "result": "OK", "time_elapsed": "1250ms",
    }
    back = act.parse_activity_row(records)
    assert back.columns == runs.columns
    expected = runs.withColumn("error_message", F.nullif(F.trim("error_message"), F.lit("")))
    assert back.exceptAll(expected).isEmpty() and expected.exceptAll(back).isEmpty()


def test_last_run_and_report(spark, runs):
    assert {(r.space_key, r.time_elapsed) for r in act.last_run(runs).collect()} == {("A", 125), ("B", 7)}
    sources = spark.createDataFrame([("src", NOW, "running", utc(2024, 1, 1))], "source string, info_date timestamp, state string, since timestamp")
    report = act.state_report(sources, runs.filter("space_key = 'B'"), spaces(spark, "A", "B", "C"), runs)
    rows = {(r.section, r.space_key): json.loads(r.report) for r in report.collect()}
    assert rows["source", None] == {
        "source": "src", "info_date": "2024-06-01T12:00:00.000Z", "state": "running", "last_restart": "2024-01-01T00:00:00.000Z",
    }
    assert rows["indexed_spaces", "C"] == {"space_key": "C"}
    assert rows["indexed_spaces", "A"]["last_indexing"]["error_message"] == "Error message"
    assert "result" not in rows["current_indexing", "B"]
    assert [r.source for r in act.list_sources(runs).collect()] == ["src"]
