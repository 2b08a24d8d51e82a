"""Exact dedup, near copies and repeated passages against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from syncspark.llm import jaccard
from syncspark.llm.components import components
from syncspark.llm.exact import drop_exact_copies, exact_dedup
from syncspark.llm.jaccard import similar_documents
from syncspark.llm.substrings import remove_repeats

from .conftest import SCHEMA

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def last(i):
    return (i is None, i or 0)


def test_exact_dedup(docs, rows):
    groups = defaultdict(list)
    for r in rows:
        groups[SPACE.sub("", r[1] or "")].append(r)
    want = Counter()
    for text, members in groups.items():
        order = sorted(members, key=lambda r: (-len(r[1] or ""), last(r[0])))
        for k, r in enumerate(order):
            want[(r[0], order[0][0], len(order), k == 0, hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter(map(tuple, exact_dedup(docs).collect())) == want


def test_drop_exact_copies_keeps_all_columns(docs, rows):
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert len(found) == len({SPACE.sub("", r[1] or "") for r in rows})
    assert not Counter(map(tuple, found)) - Counter(rows)


def test_one_text_in_all_rows_spreads_over_partitions(spark):
    many = spark.range(3000).selectExpr("id as doc_id", "'the same text' as text")
    found = exact_dedup(many).collect()
    assert {(r["keep_id"], r["group_size"]) for r in found} == {(0, 3000)}
    assert [r["doc_id"] for r in found if r["kept"]] == [0]


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(texts):
    sets, parent = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_similar_documents(spark, unique):
    want = brute_components({r[0]: r[1] for r in unique})
    assert len({c for _, c in want.values()}) < len(want)
    found = similar_documents(spark.createDataFrame(unique, SCHEMA)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want


def test_similar_documents_at_the_limit(spark):
    """Sets of 8 of 10 common shingles link, 79 of 100 don't, and links chain."""
    base = [f"w{i}" for i in range(400)]
    texts = {}
    for k, n in enumerate((9, 14, 30, 60, 104, 204)):
        texts[10 * k] = " ".join(base[:n])
        for d, cut in enumerate((0.79, 0.80, 0.81, 0.9)):
            m = round((n - 4) * cut)
            texts[10 * k + 1 + d] = " ".join(base[: m + 4])
    want = brute_components(texts)
    found = similar_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want


def test_similar_documents_where_keys_of_classes_share_names(spark, unique, monkeypatch):
    """So few names that nearly every cell has keys of several classes, all cells with boxes."""
    monkeypatch.setattr(jaccard, "FEW", 0)
    monkeypatch.setattr(jaccard, "SPARE", 0)
    monkeypatch.setattr(jaccard, "BITS", 3)
    texts = {r[0]: r[1] for r in unique}
    for k in range(300, 340):  # pairs with all but one shingle in common, short and long
        texts[2 * k] = " ".join(f"p{k}x{i}" for i in range(9 if k % 2 else 80 + k))
        texts[2 * k + 1] = texts[2 * k].rsplit(" ", 1)[0]
    want = brute_components(texts)
    found = similar_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want


def test_similar_documents_with_repeated_and_missing_ids(docs, rows):
    found = similar_documents(docs).collect()
    assert len(found) == len(rows)
    assert all(r["component_id"] is None for r in found if r["doc_id"] is None)
    assert len({r["component_id"] for r in found if r["doc_id"] in range(60, 80)}) == 1


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)], [(9, 3), (3, 9), (5, 7), (None, 2), (7, 1)]])
def test_components(spark, edges):
    parent = {}
    for a, b in edges:
        if a is not None and a != b:
            parent.setdefault(a, a), parent.setdefault(b, b)
    for _ in edges:
        for a, b in edges:
            if a is not None and a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    for few in (1000, 0):
        found = components(spark.createDataFrame(edges, "a long, b long"), few).collect()
        assert len(found) == len(parent) and {r["node"]: r["component"] for r in found} == parent


def brute_removal(rows, width=13):
    first = {}
    for i, text in rows:
        w = WORD.findall(text or "")
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(first.get(key, (True, 0)), last(i))
    out = Counter()
    for i, text in rows:
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < last(i):
                gone[k : k + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[(i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)] += 1
    return out


def test_remove_repeats(docs, rows):
    found = remove_repeats(docs, with_text=True).collect()
    want = brute_removal([r[:2] for r in rows])
    assert sum(n for _, _, n, *_ in want) > 500
    assert Counter(map(tuple, found)) == want


def test_remove_repeats_of_few_different_words(spark):
    """Runs, periods and passages at the ends of texts."""
    rows = [(1, "a " * 40), (2, "a " * 12), (3, "b " + "a " * 13), (4, "a b " * 20), (5, "b a " * 7), (6, "a a b " * 9), (7, "x " + "a b " * 8 + "y"), (8, "a " * 13)]
    found = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).collect()
    assert Counter(map(tuple, found)) == brute_removal(rows)


def test_no_rows(none):
    assert exact_dedup(none).count() == drop_exact_copies(none).count() == 0
    assert similar_documents(none).count() == remove_repeats(none).count() == 0
