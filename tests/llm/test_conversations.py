"""Repair of conversations and their prefix trie, against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from syncspark.llm import auction, prefixes
from syncspark.llm.auction import repair_conversations
from syncspark.llm.prefixes import block_nodes, conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, extra string, times long, path string, key string, kind int"
INK = re.compile(r"[^\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def order(turn):
    return (turn is not None, turn or 0)


def brute_repair(rows):
    """Each conversation by search over all edits, state by state from its end."""
    convs = defaultdict(list)
    for c, t, role, text in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        role, text, hit = role if role is not None else " ", text if text is not None else " ", zlib.crc32(key.encode()) % 20
        convs[c]
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        convs[c] += [(t, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    out = {}
    for c, of in convs.items():
        of.sort(key=lambda r: (order(r[0]), r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        turns = {t for t, _, _ in of if t is not None}
        seen, counts, faults = set(), dict.fromkeys(["blank", "duplicate", "truncated"], 0), []
        for _, role, text in of:
            ink = INK.findall(text)
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
            if fault:
                counts[fault] += 1
        need = {"": "user", "s": "user", "u": "assistant", "a": "user"}
        best = {s: (0, "", []) if s in ("", "a") else None for s in need}

        def inserted(best):
            for _ in range(4):
                for s, role in need.items():
                    after = best[role[0]]
                    if after is not None:
                        way = (after[0] + 3, "I" + after[1], [f"{role}:"] + after[2])
                        if best[s] is None or way[:2] < best[s][:2]:
                            best[s] = way
            return best

        best = inserted(best)
        for (_, role, text), fault in reversed(list(zip(of, faults))):
            before = {}
            for s in need:
                ways = [(best[s][0] + 4, "D" + best[s][1], best[s][2])]
                if fault not in ("blank", "duplicate"):
                    more = 3 * (fault == "truncated")
                    to = role[:1]
                    if to and (s, to) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                        ways.append((best[to][0] + more, "K" + best[to][1], [f"{role}:{text}"] + best[to][2]))
                    to = need[s]
                    ways.append((best[to[0]][0] + 3 + more, "R" + best[to[0]][1], [f"{to}:{text}"] + best[to[0]][2]))
                before[s] = min(ways, key=lambda w: w[:2])
            best = inserted(before)
        cost, audit, lines = best[""]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(of))
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts.values(), illegal, cost, audit, sha("\n".join(lines)))
    return out


def brute_trie(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            convs[c].append((order(t), hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()[:16], (role or "", text or "")))
    own = {c: [x[2] for x in sorted(of)] for c, of in convs.items()}
    members = defaultdict(list)
    for c, of in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole = tuple(own.get(base, [])[:h] + of[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append((c, len(whole)))
    out = []
    for node, of in members.items():
        d = len(node)
        below = [x for x in members if x[:d] == node]
        child = lambda x: [y for y in members if len(y) == len(x) + 1 and y[: len(x)] == x]
        saved = sum((len(members[x]) - 1) * len(WORD.findall(x[-1][1])) for x in below if x)
        ends = sorted(c for c, n in of if n == d)
        parent = min(c for c, _ in members[node[:-1]]) if d else None
        out.append((min(c for c, _ in of), d, parent, len(of), len(child(node)), sum(not child(x) for x in below), saved, sha(",".join(map(str, ends)))))
    return sorted(out, key=str)


TEXTS = ["Yes.", "No", "", " \n", "What?", "é ü", "same same", "End! ", "a. b", None]
ROLES = ["user", "assistant", "system", "User", "", None, "ux"]


def some_conversations(seed, n, longest):
    rng, rows = random.Random(seed), []
    for c in [None, *range(n)]:
        for t in range(rng.choice([0, 1, 2, 5, longest])):
            turn = rng.choice([t, t, t, t, None, t + 3])
            rows.append((c, turn, rng.choice(ROLES if rng.random() < 0.3 else ROLES[:2]), rng.choice(TEXTS)))
    return rows + rows[::7] + [(-7, 1, "user", "x.")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "e", 9, "p", "k", 3) for r in rows], SCHEMA).repartition(3)


def repaired(df):
    return {r[0]: tuple(r)[1:] for r in df.select(*[x.split(" ")[0] for x in auction.FOUND.split(", ")]).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_repair(spark, seed):
    rows = some_conversations(seed, 40, 9)
    assert repaired(repair_conversations(frame(spark, rows))) == brute_repair(rows)


def test_repair_of_long_conversations(spark):
    """Most rows in one conversation, over many segments and ranges; equal rows thousands of times."""
    rng = random.Random(5)
    rows = [(5, t, rng.choice(ROLES[:2] if rng.random() < 0.9 else ROLES), rng.choice([f"text {t}.", f"text {t}", "Yes."])) for t in range(700)]
    rows += [(5, 33, "user", "again.")] * 900 + some_conversations(3, 10, 50) + [(6, t, "assistant", "") for t in range(300)]
    rows += [(77, 3, "user", "word " * 300_000 + "."), (77, 4, "assistant", "a")]
    assert repaired(repair_conversations(frame(spark, rows))) == brute_repair(rows)


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(empty).collect() == []
    assert conversation_trie(empty).collect() == []
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert repaired(repair_conversations(frame(spark, [(dropped, 0, "user", "x")]))) == {dropped: (0, 0, 0, 0, 0, 0, "", sha(""))}


def test_prices_are_costs(spark):
    """Every conversation of up to four rows: the price of the origin is the least cost, and the letters the least."""
    for n in range(5):
        for codes in map("".join, itertools.product("suaxUA", repeat=n)):
            arcs, end = auction._arcs(codes, auction.LAST)
            best = {end: (0, "")}
            for _ in range(3 * len(arcs)):
                for node in range(len(arcs) - 1, -1, -1):
                    for letter, cost, to in arcs[node]:
                        if to in best and (way := (cost + best[to][0], letter + best[to][1])) < best.get(node, (99, "")):
                            best[node] = way
                if n < 3:
                    break
            price = auction.prices(codes, auction.LAST)
            assert all(price[i] <= c + price[j] for i in range(len(arcs)) for _, c, j in arcs[i])
            if n < 3:
                continue
            assert (price[0], auction.trace(codes, auction.LAST, (0,), 0)[0]) == best[0]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trie(spark, seed):
    rng = random.Random(seed)
    rows = [r for r in some_conversations(seed, 70, 7) if r[2] in (None, "user", "assistant")]
    same = [("user", "Yes."), ("assistant", "No"), ("user", "more words here")]
    for c in range(100, 130):  # copies, and copies that go on
        rows += [(c, t, *same[t]) for t in range(rng.choice([1, 2, 3, 3, 3]))]
    rows += [(140, t, "user", f"turn {t // 2}") for t in range(60)] + [(143, t, "user", f"turn {t // 2}") for t in range(50)]
    want = brute_trie(rows)
    for blocks in (1, 5, 40):
        lists = prefixes.rebuilt(prefixes.turn_lists(frame(spark, rows)))
        found = prefixes.prefix_trie(lists, blocks)
        assert sorted(map(tuple, found.select(*[x.split(" ")[0] for x in prefixes.NODES.split(", ")]).collect()), key=str) == want


def test_trie_keeps_the_hash_of_many_ids(spark, monkeypatch):
    lists = spark.range(30_000).selectExpr("id as conv_id", "array(named_struct('name', unhex(repeat('ab', 16)), 'words', 2)) as turns")
    rows = {r["depth"]: r for r in prefixes.prefix_trie(lists, 7).collect()}
    assert rows[1]["ends_sha256"] == sha(",".join(map(str, range(30_000)))) and rows[0]["ends_sha256"] == sha("")
    assert (rows[0]["n_convs"], rows[0]["n_children"], rows[0]["n_leaves"], rows[0]["saved_tokens"]) == (30_000, 1, 1, 2 * 29_999)


def test_range_minimum():
    np = prefixes.np
    rng = np.random.default_rng(1)
    values = rng.integers(0, 5, 100)
    table = prefixes.RangeMinimum(values)
    a = rng.integers(0, 100, 500)
    b = np.minimum(a + rng.integers(0, 60, 500), 99)
    assert table.least(a, b).tolist() == [values[x : y + 1].min() for x, y in zip(a, b)]
    depth = rng.integers(0, 6, 500)
    for i, d, right, left in zip(a, depth, table.right(a, depth), table.left(a, depth)):
        assert all(values[i + 1 : right + 1] >= d) and (right == 99 or values[right + 1] < d)
        assert all(values[left + 1 : i + 1] >= d) and (left == 0 or values[left] < d)


def test_empty_block():
    assert block_nodes(prefixes.np.zeros(0, int), [], [], 0) == []
