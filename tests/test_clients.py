"""The remote system of the workload: order and size of what it answers."""

import json
import tracemalloc

import pytest
from pyspark.sql import functions as F

from workload.clients import PAGE, EventClient, remote_events


@pytest.fixture
def remote(spark, tmp_path):
    """A remote system of ``n`` events in no order, some of the same time, in several files."""

    def make(n):
        folder = str(tmp_path / str(n))
        spark.range(n).select(
            F.col("id").alias("event_id"), F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(n // 3))).cast("timestamp_ntz").alias("ts"),
            F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40)).alias("user_id"), F.lit("view").alias("event_type"), F.lit(0.5).alias("value"),
        ).write.parquet(f"{folder}/events.parquet")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            return spark.read.parquet(f"{folder}/events.parquet"), EventClient(remote_events(spark, folder))
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    return make


def answers(client, space, after=None, before=None):
    at, total = 0, 1
    while at < total:
        page = client.page(space, at, True, after, before)
        at, total = at + page.count, page.total
        yield json.loads(page.payload)
        assert page.count or not total


def test_pages_are_in_order_and_whole(remote):
    events, client = remote(9000)
    rows = sorted((r.ts, r.event_id, r.user_id) for r in events.collect())
    low, high = rows[2000][0], rows[7000][0]
    for space in range(5):
        mine = [str(i) for _, i, user in rows if user % 5 == space]
        found = list(answers(client, f"S{space}"))
        assert [d["id"] for page in found for d in page] == mine and {len(page) for page in found[:-1]} == {PAGE}
        between = [str(i) for ts, i, user in rows if user % 5 == space and low <= ts <= high]
        assert [d["id"] for page in answers(client, f"S{space}", low, high) for d in page] == between
        assert json.loads(client.page(f"S{space}", 700, True, None, None).payload) == (found[1] + found[2])[200:700]
    assert client.page("S9", 0, True, None, None)[1:] == (0, 0)


def test_memory_does_not_grow_with_a_space(remote):
    def peak(n):
        client = remote(n)[1]
        tracemalloc.start()
        assert sum(map(len, answers(client, "S1"))) > n / 6
        try:
            return tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    small, large = peak(50_000), peak(400_000)
    assert large < 1.3 * small
