"""Mixing and sharding."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from syncspark.llm.mixing import mix_sources, repeat_documents, source_targets
from syncspark.llm.sharding import Node, place, shard_documents, tree

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, full = 1.5 * sum(sizes.values()), {}, set()
    while True:
        rest = {s for s in names if s not in full}
        total = sum(weight[s] for s in rest)
        target |= {s: left * weight[s] / total for s in rest}
        over = {s for s in rest if target[s] > 2 * sizes[s] + 1e-9}
        if not over:
            return target
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 3, None: 50, "é": 7}, {"z": 0, "y": 5}, {None: 4}, {"a": 0}])
def test_source_targets(spark, sizes):
    found = source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
    assert {r["source"]: r["target"] for r in found} == pytest.approx(brute_targets(sizes))


def test_mix_sources(docs, rows):
    found = mix_sources(docs).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in found) == Counter((r[0], r[2], len(WORD.findall(r[1] or ""))) for r in rows)
    by = defaultdict(list)
    for r in found:
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        by[r["source"]].append(r)
    want = brute_targets({s: sum(r["size"] for r in of) for s, of in by.items()})
    for s, of in by.items():
        assert of[0]["target"] == pytest.approx(want[s])
        assert abs(sum(r["taken"] for r in of) - want[s]) <= max(r["size"] for r in of)
    assert Counter(map(tuple, found)) == Counter(map(tuple, mix_sources(docs).collect()))


def test_mixing_is_fair(spark):
    """Over many seeds a document is taken as often as its source's target says."""
    rows = spark.range(360).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 9 as int)) as text", "cast(id % 2 as string) as source").cache()
    taken, rate = Counter(), {}
    for seed in range(4):
        for r in mix_sources(rows, seed=seed).collect():
            taken[r["doc_id"] % 18] += r["copies"]
            rate[r["doc_id"] % 18] = r["target"] / r["source_size"]
    for k, n in taken.items():
        assert n / (4 * 20) == pytest.approx(rate[k], abs=0.3)


def test_repeat_documents(docs):
    found = repeat_documents(docs)
    assert found.columns == docs.columns
    plan = mix_sources(docs).filter("doc_id between 1 and 59").collect()
    counts = Counter(r["doc_id"] for r in found.collect())
    assert all(counts[r["doc_id"]] == r["copies"] for r in plan)


def test_shard_documents(docs, rows):
    found = shard_documents(docs).collect()
    text = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in rows)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16) and r["law"] == "key"
        if r["doc_id"] is not None:
            data = text[r["doc_id"]].encode()
            assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r["doc_id"], r["shard"]) for r in found}) == len({r["doc_id"] for r in found})


def test_shards_are_even_and_growth_moves_one_share(spark):
    found = shard_documents(spark.range(40_000).selectExpr("id as doc_id", "'' as text"))
    counts = [r["n"] for r in found.groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert len(counts) == 16 and max(counts) < 1.1 * 2500 and min(counts) > 0.9 * 2500
    moved = found.filter("grown_shard <> shard").count()
    assert 0.9 < moved / (40_000 / 17) < 1.1


def test_weights_of_a_tree(spark):
    one = Node("r", (Node("a", (Node("a/1", shard=0, own_weight=3.0), Node("a/2", shard=1))), Node("b", shard=2, own_weight=4.0)))
    rows = spark.range(20_000).select(place(F.col("id").cast("string"), one).alias("s")).groupBy("s").count().collect()
    assert {r["s"]: r["count"] / 20_000 for r in rows} == pytest.approx({0: 3 / 8, 1: 1 / 8, 2: 1 / 2}, abs=0.02)
    # More weight below b moves rows only into b.
    more = Node("r", (one.children[0], Node("b", shard=2, own_weight=6.0)))
    both = spark.range(5000).select(place(F.col("id").cast("string"), one).alias("x"), place(F.col("id").cast("string"), more).alias("y"))
    assert both.filter("x <> y and y <> 2").count() == 0


def test_no_rows(none):
    assert mix_sources(none).count() == shard_documents(none).count() == 0
