"""Sharding by a hierarchical weighted hash tree.

A document descends from the root over region and rack to a shard. At each node every
child draws a number from a hash of the document and the child's name, scaled by the
child's weight (the weights of the shards below it), and the smallest draw wins. A change
of weight moves documents only into or out of the subtrees whose weights changed. A new
shard opens a region of its own, so that it takes documents only into itself.

Built-in functions alone: the tree is a parameter, unrolled into expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import body, written

ROWS = 8192  # about as many rows are numbered in one group


@dataclass(frozen=True)
class Node:
    """A region, a rack or (with ``shard``) a leaf. Names are unique in the tree."""

    name: str
    children: tuple["Node", ...] = ()
    shard: int = -1
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree(shards: int, added: int = 0, racks: int = 2, per_rack: int = 2) -> Node:
    """``shards`` shards, ``per_rack`` to a rack and ``racks`` racks to a region, then a region for each added shard."""
    per_region, regions = racks * per_rack, []
    for first in range(0, shards, per_region):
        in_region = range(first, min(first + per_region, shards))
        parts = [in_region[i : i + per_rack] for i in range(0, len(in_region), per_rack)]
        r = f"g{first // per_region}"
        regions.append(Node(r, tuple(Node(f"{r}/k{k}", tuple(Node(f"{r}/k{k}/s{s}", shard=s) for s in part)) for k, part in enumerate(parts))))
    for s in range(shards, shards + added):
        regions.append(Node(f"a{s}", (Node(f"a{s}/k0", (Node(f"a{s}/k0/s{s}", shard=s),)),)))
    return Node("", tuple(regions))


def _uniform(key: Column, name: str) -> Column:
    """A number above 0 and up to 1 from 52 bits of a digest."""
    digits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{name}"))), 1, 13), 16, 10)
    return (digits.cast("double") + 1) / F.lit(float(1 << 52))


def place(key: Column, node: Node) -> Column:
    """The shard of a key (a string that isn't null) below a node."""
    if not node.children:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return place(key, node.children[0])
    draws = F.array(*[F.struct((-F.ln(_uniform(key, c.name)) / F.lit(float(c.weight))).alias("draw"), F.lit(i).alias("i")) for i, c in enumerate(node.children)])
    won = F.array_min(draws)["i"]
    below = F.when(won == 0, place(key, node.children[0]))
    for i, child in enumerate(node.children[1:], 1):
        below = below.when(won == i, place(key, child))
    return below


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Shard and slot of each document.

    Returns a row per row of ``docs``: doc_id, size (UTF-8 bytes of the text plus 1),
    text_crc32, law ("key": id and number of shards decide), shard, slot (from 0, without
    gaps, in the order of a hash of the id), grown_shard (with one shard more). A null text
    has no bytes; null ids share one place; repeated rows share a shard and have slots of
    their own; no rows give no rows. Other columns aren't read.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select(
        "doc_id", (F.octet_length(body()) + 1).cast("long").alias("size"), F.crc32(F.encode(body(), "UTF-8")).alias("text_crc32"), F.lit("key").alias("law"),
        place(key, tree(shards)).cast("int").alias("shard"), place(key, tree(shards, 1)).cast("int").alias("grown_shard"), F.md5(F.concat(key, F.lit(":slot"))).alias("at"),
    )
    rows = written(rows, "placed")
    digits = max(0, math.ceil(math.log(max(1, rows.count()) / (ROWS * shards), 16)))
    # Rows are numbered in small groups, from where the groups before them end.
    rows = rows.withColumn("part", F.substring("at", 1, digits))
    groups = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place_in = Window.partitionBy("shard", "part").orderBy("at", F.col("doc_id").asc_nulls_last(), "text_crc32", "size")
    rows = rows.withColumn("i", F.row_number().over(place_in)).join(groups, ["shard", "part"])
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", (F.col("start") + F.col("i") - 1).alias("slot"), "grown_shard")
