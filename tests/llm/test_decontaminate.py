"""Decontamination against brute force."""

import hashlib
import random
import re

import pytest

from syncspark.llm import decontaminate as dec
from syncspark.llm.decontaminate import contamination, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(docs, items, words=10):
    grams = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        n = min(words, len(w))
        for i in range(len(w) - n + 1) if n else []:
            grams.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = WORD.findall(lower(text)), set(), set()
        for n in range(1, words + 1):
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i : i + n])) in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[g]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def made():
    rng = random.Random(8)
    word = lambda: rng.choice(["Alpha", "beta", "g4mma", "delta", "été", "日本", "x"]) + str(rng.randrange(60))
    text = lambda n: "".join(word() + rng.choice([" ", ", ", "\n", "-", "_", " \x7f"]) for _ in range(n))
    items = [(i, text(rng.choice([10, 12, 30]))) for i in range(20)]
    items += [(20, text(4)), (21, "one"), (22, ""), (23, None), (24, " .,- "), (None, text(11)), (3, text(12)), (7, items[7][1]), (25, items[7][1]), (26, items[0][1].upper())]
    docs = [(i, text(rng.choice([0, 3, 9, 10, 50]))) for i in range(40)]
    for i in range(40, 60):
        part = rng.choice(items[:20])[1]
        docs.append((i, "..A " + text(5) + part.replace(" ", "  ").upper() + text(5)))
    docs += [(60, "One ONE two"), (61, None), (62, ""), (63, items[5][1] * 40), (64, text(20_000) + items[6][1]), (65, items[1][1][: len(items[1][1]) // 2]), (66, items[20][1] * 2 + items[24][1])]
    docs += [(None, items[2][1]), (None, "clean"), (5, items[2][1]), (63, docs[-2][1])]
    return docs, items


def tables(spark, docs, items):
    d = spark.createDataFrame([(*r, "a", i, "b") for i, r in enumerate(docs)], "doc_id long, text string, words string, _row long, row string").repartition(3)
    return d, spark.createDataFrame([(*r, "z", 1) for r in items], "item_id long, text string, window string, length int")


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_contamination(spark, monkeypatch, limit):
    monkeypatch.setattr(dec, "BROADCAST_BYTES", limit)
    docs, items = made()
    assert sorted(map(tuple, contamination(*tables(spark, docs, items)).select(*COLUMNS).collect()), key=str) == brute(docs, items)


def test_hashes_are_verified(spark, monkeypatch):
    """With a hash that says nothing, the words decide."""
    monkeypatch.setattr(dec, "_hash", lambda words, start, length: dec.F.xxhash64(dec.F.lit(1)))
    docs, items = [(1, "a b c d e f g h i j k"), (2, "q b c d e f g h i j k")], [(9, "a b c d e f g h i j")]
    assert sorted(map(tuple, contamination(*tables(spark, docs, items)).select(*COLUMNS).collect()), key=str) == brute(docs, items)


def test_removal(spark):
    docs, items = made()
    d, b = tables(spark, docs, items)
    dirty = {r[0] for r in brute(docs, items) if r[-1]}
    whole = decontaminate(d, b, "documents")
    assert whole.columns == d.columns and {r["doc_id"] for r in whole.collect()} >= {r[0] for r in docs if r[0] is not None} - dirty
    cut = decontaminate(d, b, "spans")
    assert cut.columns == d.columns and cut.count() == len(docs)
    left = {(r["doc_id"], r["_row"]): r["text"] for r in cut.collect()}
    n = {r[0]: r[1] - r[2] for r in brute(docs, items) if r[0] not in (None, 63, 5)}
    for (doc, i), text in left.items():
        if doc in n:
            assert len(WORD.findall(lower(text))) == n[doc]
            if doc not in dirty:
                assert text == docs[i][1]
    with pytest.raises(ValueError):
        decontaminate(d, b, "words")


def test_empty_tables(spark):
    docs, items = made()
    d, b = tables(spark, docs, items)
    assert contamination(d.limit(0), b).collect() == []
    assert not any(r["contaminated"] for r in contamination(d, b.limit(0)).collect())
    assert contamination(d, b.limit(0)).count() == len(docs) and decontaminate(d, b.limit(0)).count() == len(docs)
