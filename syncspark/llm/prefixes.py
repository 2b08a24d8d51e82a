"""Prefix trie of conversations by range minima over sorted common prefixes.

Conversations are sorted by their turns over ranges of the cluster. Within a range (block)
the common prefixes of neighbours make an array with a sparse table of its minima. A prefix
of a conversation is a candidate node; its members are the stretch of neighbours that share
as many turns, whose left and right end are found by binary search over the table, each
candidate on its own. Nodes are complete unless they reach the edge of their block: these are
prefixes of the first or the last conversation of a block, are merged by a digest of the
prefix, and form a small trie on top that hands its sums up.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import WORD, partitions, ready, written

SHARED_TURNS = 3  # of another conversation, at most
NAME = 16  # bytes of a turn's digest
BLOCK_TURNS = 400_000
PIECE = 10_000  # ids of a node hashed at a time

NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
BLOCKS = (
    "kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
    "node binary, parent binary, words long, block int, piece int, ends string"
)
_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _KINDS[k]) for n, k in (x.split(" ") for x in ddl.split(", "))])


def turn_lists(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turns): the turns of each conversation in order, as (name, words)."""
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    name = F.unhex(F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256), 1, 2 * NAME))
    named = rows.select("conv_id", F.struct(F.col("turn").isNotNull().alias("has"), "turn", name.alias("name"), F.regexp_count("text", F.lit(WORD)).cast("int").alias("words")).alias("at"))
    lists = named.groupBy("conv_id").agg(F.array_sort(F.collect_list("at")).alias("turns"))
    return lists.select("conv_id", F.transform("turns", lambda t: F.struct(t["name"].alias("name"), t["words"].alias("words"))).alias("turns"))


def rebuilt(lists: DataFrame) -> DataFrame:
    """Conversations with their first turns taken from the one their group of twenty begins with."""
    group = F.col("conv_id") - F.col("conv_id") % 20
    heads = lists.filter("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, SHARED_TURNS).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (SHARED_TURNS + 1)).cast("int")
    both = lists.withColumn("base", group).join(heads, "base", "left").withColumn("h", h)
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return both.select("conv_id", F.concat(head, own).alias("turns"))


class RangeMinimum:
    """Sparse table: the least of any stretch of an array in two look-ups."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        step = 1
        while 2 * step <= len(values):
            low = self.rows[-1]
            self.rows.append(np.minimum(low[:-step], low[step:]))
            step *= 2

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least of values[a..b], both ends in, for arrays of a and b."""
        level = np.floor(np.log2(b - a + 1)).astype(np.int64)
        out = np.empty(len(a), self.rows[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.rows[k][a[at]], self.rows[k][b[at] - (1 << int(k)) + 1])
        return out

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Last place up to which all values after ``at`` are ``depth`` or more."""
        at, n = at.copy(), len(self.rows[0])
        for k in range(len(self.rows) - 1, -1, -1):
            to = at + (1 << k)
            ok = np.flatnonzero(to < n)
            ok = ok[self.rows[k][at[ok] + 1] >= depth[ok]]
            at[ok] = to[ok]
        return at

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """First place from which all values up to ``at`` are ``depth`` or more; the place before
        a stretch is the one that its first value compares with."""
        at = at.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            to = at - (1 << k)
            ok = np.flatnonzero(to >= 0)
            ok = ok[self.rows[k][to[ok] + 1] >= depth[ok]]
            at[ok] = to[ok]
        return at


def common_prefixes(keys: list[bytes]) -> np.ndarray:
    """Turns that each key shares with the one before it (0 for the first)."""
    out = np.zeros(len(keys), np.int64)
    for i in range(1, len(keys)):
        a, b = keys[i - 1], keys[i]
        if a == b:
            out[i] = len(a) // NAME
            continue
        n = min(len(a), len(b))
        low, high = 0, n // NAME  # the longest equal stretch, by halves
        while low < high:
            mid = (low + high + 1) // 2
            if a[: mid * NAME] == b[: mid * NAME]:
                low = mid
            else:
                high = mid - 1
        out[i] = low
    return out


def _digests(key: bytes) -> list[bytes]:
    """A digest of each prefix of a sequence, from none to all."""
    out = [hashlib.sha256(b"").digest()[:NAME]]
    for i in range(0, len(key), NAME):
        out.append(hashlib.sha256(out[-1] + key[i : i + NAME]).digest()[:NAME])
    return out


def block_nodes(ids: np.ndarray, keys: list[bytes], words: list[np.ndarray], block: int) -> list[dict]:
    """Nodes of a block of sorted conversations: complete ones (kind 0), those at its edges
    (kind 1), and the ids that end in an edge node (kind 2, in pieces)."""
    m = len(ids)
    if not m:
        return []
    length = np.array([len(k) // NAME for k in keys])
    lcp = common_prefixes(keys)
    table, least = RangeMinimum(lcp), RangeMinimum(ids)
    # Candidates: prefixes that a conversation does not share with the one before it, and of
    # the first one all. In this order a node comes before its subtree.
    begin = np.where(np.arange(m) == 0, 0, lcp + 1)
    each = np.maximum(length - begin + 1, 0)
    at = np.repeat(np.arange(m), each)
    start = np.concatenate([[0], np.cumsum(each)])
    depth = np.arange(len(at)) - start[at] + begin[at]
    l, r = table.left(at, depth), table.right(at, depth)  # noqa: E741
    smallest, n = least.least(l, r), r - l + 1
    edge = (l == 0) | (r == m - 1)
    count, inner = len(at), depth > 0
    # A parent is one turn shorter, a candidate of the first conversation that has as much.
    first = table.left(at, np.maximum(depth - 1, 0))
    parent = np.where(inner, start[first] + depth - 1 - begin[first], -1)
    stop = start[r + 1]  # a subtree goes on to the last candidate of its last member
    last_words = np.array([int(words[i][d - 1]) if d else 0 for i, d in zip(at.tolist(), depth.tolist(), strict=True)], np.int64)
    childless = (length[r] == depth) & ~edge
    own = np.where(edge, 0, (n - 1) * last_words)
    leaves, saved = [np.concatenate([[0], np.cumsum(x)]) for x in (childless.astype(np.int64), own)]
    children = np.bincount(parent[inner & ~edge], minlength=count)
    here = np.arange(count)
    n_leaves, n_saved = leaves[stop] - leaves[here], saved[stop] - saved[here]
    # Members that end here are the first of a node's members, in the order of their ids.
    ends = np.where(length[l] == depth, _last_equal(length, l, r, depth), l - 1)
    names = {0: _digests(keys[0]), m - 1: _digests(keys[-1])}
    node_of = lambda j: names[0 if l[j] == 0 else m - 1][depth[j]]
    out = []
    # Of an edge node: what hangs on it in this block but not on an edge node below it.
    below = {}
    for j in np.flatnonzero(edge & inner).tolist():
        p = int(parent[j])
        a, b = below.get(p, (0, 0))
        below[p] = (a + int(n_leaves[j]), b + int(n_saved[j]))
    for j in range(count):
        ending = ids[l[j] : ends[j] + 1]
        if not edge[j]:
            p = int(parent[j])
            row = {
                "kind": 0, "conv_id": int(smallest[j]), "depth": int(depth[j]), "n_convs": int(n[j]), "n_children": int(children[j]), "n_leaves": int(n_leaves[j]),
                "saved_tokens": int(n_saved[j]), "ends_sha256": hashlib.sha256(",".join(map(str, ending.tolist())).encode()).hexdigest(),
            }
            out.append(row | ({"parent": node_of(p)} if edge[p] else {"parent_conv_id": int(smallest[p])}))
            continue
        a, b = below.get(j, (0, 0))
        out.append({
            "kind": 1, "conv_id": int(smallest[j]), "depth": int(depth[j]), "n_convs": int(n[j]), "n_children": int(children[j]), "n_leaves": int(n_leaves[j]) - a,
            "saved_tokens": int(n_saved[j]) - b, "node": node_of(j), "parent": node_of(int(parent[j])) if depth[j] else None, "words": int(last_words[j]), "block": block,
        })
        for piece, i in enumerate(range(0, len(ending), PIECE)):
            out.append({"kind": 2, "node": node_of(j), "block": block, "piece": piece, "ends": ",".join(map(str, ending[i : i + PIECE].tolist()))})
    return out


def _last_equal(length: np.ndarray, l: np.ndarray, r: np.ndarray, depth: np.ndarray) -> np.ndarray:  # noqa: E741
    """Last of the members l..r with no more turns than the node; these come first."""
    low, high = l.copy(), r.copy()
    while (open_ := low < high).any():
        mid = (low + high + 1) // 2
        short = length[mid] == depth
        low = np.where(open_ & short, mid, low)
        high = np.where(open_ & ~short, mid - 1, high)
    return low


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, keys, words = [], [], []
    for batch in batches:
        ids += batch["conv_id"].to_pylist()
        keys += batch["key"].to_pylist()
        words += [np.array(w, np.int64) for w in batch["words"].to_pylist()]
    rows, schema = block_nodes(np.array(ids, np.int64), keys, words, TaskContext.get().partitionId()), _schema(BLOCKS)
    for i in range(0, len(rows), 4096):
        some = rows[i : i + 4096]
        yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in some], f.type) for f in schema], schema=schema)


def _top(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of the trie of edge nodes, from the deepest to the root."""
    found = list(frames)
    if not found:
        return
    nodes = pd.concat(found, ignore_index=True)
    at = {k: i for i, k in enumerate(nodes["node"])}
    up = [-1 if p is None else at[p] for p in nodes["parent"]]
    children, leaves = nodes["n_children"].to_numpy().copy(), nodes["n_leaves"].to_numpy().copy()
    for p in up:
        if p >= 0:
            children[p] += 1
    leaves += children == 0
    saved = nodes["saved_tokens"].to_numpy() + (nodes["n_convs"].to_numpy() - 1) * nodes["words"].to_numpy()
    for i in np.argsort(-nodes["depth"].to_numpy(), kind="stable").tolist():
        if up[i] >= 0:
            leaves[up[i]] += leaves[i]
            saved[up[i]] += saved[i]
    least = nodes["conv_id"].to_numpy()
    nodes["parent_conv_id"] = pd.array([None if p < 0 else int(least[p]) for p in up], "Int64")
    yield nodes.assign(n_children=children, n_leaves=leaves, saved_tokens=saved)[["node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the pieces of each node, in order, as one text."""
    now, state = None, None
    for batch in batches:
        nodes, digests = [], []
        for node, text in zip(batch["node"].to_pylist(), batch["ends"].to_pylist(), strict=True):
            if node != now:
                if now is not None:
                    nodes.append(now)
                    digests.append(state.hexdigest())
                now, state = node, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests)], names=["node", "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])


def prefix_trie(sequences: DataFrame, blocks: int | None = None) -> DataFrame:
    """Nodes of the trie of turn sequences, a row each.

    ``sequences``: conv_id (a row each) and turns, an array of (name, words). Returns conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. A sequence
    without turns is a member of the root alone. No rows give no nodes. A task holds a block of
    conversations, 16 bytes a turn.
    """
    spark = sequences.sparkSession
    ready(spark)
    rows = sequences.select("conv_id", F.array_join(F.transform("turns", lambda t: F.hex(t["name"])), "").alias("key"), F.transform("turns", lambda t: t["words"]).alias("words"))
    rows = written(rows.withColumn("key", F.unhex("key")), "sequences")
    if blocks is None:
        turns = rows.agg(F.sum(F.size("words") + 1)).first()[0] or 0
        blocks = max(partitions(spark), math.ceil(turns / BLOCK_TURNS))
    ranged = rows.repartitionByRange(blocks, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    found = written(ranged.mapInArrow(_blocks, BLOCKS), "nodes")
    edge = found.filter("kind = 1").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("words").alias("words"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    top = written(edge.repartition(1).mapInPandas(_top, "node binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"), "top")
    pieces = found.filter("kind = 2").select("node", "block", "piece", "ends").repartition("node").sortWithinPartitions("node", "block", "piece")
    ends = pieces.mapInArrow(_hashed, "node binary, ends_sha256 string")
    columns = [x.split(" ")[0] for x in NODES.split(", ")]
    tops = top.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    above = top.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    inner = found.filter("kind = 0").drop("node").join(above, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return inner.select(*columns).unionByName(tops.select(*columns))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations: each takes its first turns (0 to 3, by the CRC-32 of its
    id) from the one whose id its group of twenty begins with, then goes on with its own.

    ``conversations``: conv_id, turn, role, text. Rows without a conv_id are left out. A null
    turn comes first, a null role or text is empty; rows of one turn come by the digest of role
    and text, and repeated rows are turns each. Texts may have any length; no rows, no nodes.
    """
    return prefix_trie(rebuilt(turn_lists(conversations)))
