"""Mixing sources to target weights by pivotal dependent rounding.

A document's expected number of copies is its source's target over its source's size. The
whole part is taken as it is. The fractions are paired: words move at random from one
document of the pair to the other until one of them is whole, so that the pair's words
stay the same and the expectation of each document too. What is left of a block is one
fraction; fractions meet in blocks of the next level, up to one per source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, body, carried, written

BLOCK = 64
_PER = ("source", "source_size", "target")
_STATE = "struct<left:struct<id:bigint,seed:bigint,size:bigint,whole:bigint,p:double>,done:array<struct<id:bigint,size:bigint,copies:bigint>>>"


def source_targets(sizes: DataFrame, share: float = 1.5, repeats: float = 2.0, weights: tuple[float, ...] = (5.0, 2.0, 1.0)) -> DataFrame:
    """Rows (source, n, source_size, target) of all sources from rows (source, size).

    Weights go round the sources by code point, null last. A target stops at ``repeats``
    times the source's size; the excess is shared again by weight, which ends where every
    source gets the same multiple of its weight or its limit.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    every = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(every) - 1) % len(weights)
    per = per.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))).withColumn("most", repeats * F.col("source_size"))
    # By the multiple at which each is full: those before are full, the rest share what is left.
    by = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    per = per.withColumn("total", F.least(F.sum("source_size").over(whole) * share, F.sum("most").over(whole)))
    per = per.withColumn("full", F.coalesce(F.sum("most").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    per = per.withColumn("at", F.row_number().over(by))
    per = per.withColumn("rest", F.sum("w").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    per = per.withColumn("level", (F.col("total") - F.col("full")) / F.col("rest"))
    # The level that holds is that of the first source it doesn't fill.
    first = F.min(F.when(F.col("level") * F.col("w") <= F.col("most"), F.struct("at", "level"))).over(whole)["level"]
    per = per.withColumn("level", F.coalesce(first, F.max(F.col("most") / F.col("w")).over(whole)))
    return per.select("source", "n", "source_size", F.least(F.col("level") * F.col("w"), F.col("most")).alias("target"))


def _fold(block: Column) -> Column:
    """Pair the fractions of a block one after another."""

    def item(x: Column) -> Column:
        return F.struct(x["id"].alias("id"), x["seed"].alias("seed"), x["size"].alias("size"), x["whole"].alias("whole"), x["p"].alias("p"))

    def move(state: Column, x: Column) -> Column:
        a, p, s, q, t = state["left"], state["left"]["p"], state["left"]["size"], x["p"], x["size"]
        to_a, to_x = F.least((1 - p) * s, q * t), F.least(p * s, (1 - q) * t)
        draw = F.pmod(F.xxhash64(a["seed"], x["seed"]), F.lit(1 << 52)) / F.lit(float(1 << 52))
        up = (to_a + to_x > 0) & (draw * (to_a + to_x) < to_x)
        ends_a = F.when(up, (1 - p) * s <= q * t).otherwise(p * s <= (1 - q) * t)
        moved = F.when(up, to_a).otherwise(-to_x)
        bound = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
        # The one that ended is up, or down, to a whole number of copies.
        ended = F.when(ends_a, F.struct(a["id"].alias("id"), s.alias("size"), (a["whole"] + F.when(up, 1).otherwise(0)).cast("long").alias("copies"))).otherwise(
            F.struct(x["id"].alias("id"), t.alias("size"), (x["whole"] + F.when(up, 0).otherwise(1)).cast("long").alias("copies")))
        left = F.when(ends_a, F.struct(x["id"].alias("id"), x["seed"].alias("seed"), t.alias("size"), x["whole"].alias("whole"), bound(q - moved / t).alias("p"))).otherwise(
            F.struct(a["id"].alias("id"), a["seed"].alias("seed"), s.alias("size"), a["whole"].alias("whole"), bound(p + moved / s).alias("p")))
        return F.struct(left.alias("left"), F.array_append(state["done"], ended).alias("done")).cast(_STATE)

    start = F.struct(item(block[0]).alias("left"), F.array().cast("array<struct<id:bigint,size:bigint,copies:bigint>>").alias("done")).cast(_STATE)
    return F.aggregate(F.slice(block, 2, 1 << 30), start, move)


def mix_sources(docs: DataFrame, share: float = 1.5, repeats: float = 2.0, weights: tuple[float, ...] = (5.0, 2.0, 1.0), seed: int = 7, row: str = "doc_id") -> DataFrame:
    """How often each document is taken so that every source nears its target.

    Returns a row per row of ``docs``: doc_id, source, size (words), source_size, target,
    copies, taken (copies times size). A source's words differ from its target by less than
    its largest document. A null text has no words and is taken as often as its source's
    whole part says; a null source is a source. Reruns agree: every draw is a hash of ids.
    Repeated rows count each on its own. No rows give no rows. ``row`` names a column of
    bigint that stands for a row in the result, as doc_id; draws are by id and text all the same.
    """
    # Blocks are dealt by the text as well, so that rows without an id don't meet in one.
    mark = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"), body())
    sizes = written(docs.select(F.col(row).alias("id"), "source", F.regexp_count(body(), F.lit(WORD)).cast("long").alias("size"), mark.alias("seed")), "sizes")
    targets = source_targets(sizes, share, repeats, weights)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.withColumn("whole", F.floor(rate)).withColumn("p", rate - F.floor(rate))
    rows = sizes.withColumnRenamed("source", "of").join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows = rows.withColumnRenamed("id", "doc_id")
    firm = (F.col("p") <= 0) | (F.col("size") == 0)
    out = rows.filter(firm).select("doc_id", *_PER, "size", F.col("whole").alias("copies"))

    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK))
    left = rows.filter(~firm).select(*_PER, F.pmod("seed", blocks).alias("block"), F.struct("seed", F.col("doc_id").alias("id"), "size", "whole", "p").alias("x"))
    count, level = math.ceil(sizes.count() / BLOCK), 0
    while True:
        state = left.groupBy(*_PER, "block").agg(F.sort_array(F.collect_list("x")).alias("x")).select(*_PER, "block", _fold(F.col("x")).alias("s"))
        state = written(state, f"level{level}")
        ended = state.select(*_PER, F.explode("s.done").alias("d"))
        out = out.union(ended.select(F.col("d.id"), *_PER, "d.size", "d.copies"))
        if count <= 1:
            break
        left = state.select(*_PER, F.floor(F.col("block") / BLOCK).alias("block"), F.struct("s.left.seed", "s.left.id", "s.left.size", "s.left.whole", "s.left.p").alias("x"))
        count, level = math.ceil(count / BLOCK), level + 1
    # One fraction a source is left: a draw decides it.
    draw = F.pmod(F.xxhash64("s.left.seed", F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    last = state.select(F.col("s.left.id"), *_PER, "s.left.size", (F.col("s.left.whole") + F.when(draw < F.col("s.left.p"), 1).otherwise(0)).cast("long"))
    return out.union(last).withColumn("taken", F.col("copies") * F.col("size"))


def repeat_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs``, all its columns, as often as it is taken.

    Rows without an id, or that repeat one, are taken each on its own. Which of those that are
    also equal in source and words are taken more often follows the order they are stored in.
    """
    rows = carried(docs)
    plan = mix_sources(rows, row="_row", **options).select(F.col("doc_id").alias("_row"), F.col("copies").cast("int").alias("copies")).filter("copies > 0")
    return rows.select("_row", "row").join(plan, "_row").select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
